"""Data-quality rules and reports.

A rule is a condition that marks violating rows.  A report is one aggregate
pass with one output row per rule: ``rule, checked, failed, passed``.  The same
counters can ride along a write as observed metrics.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import TIME_OF_DAY_VALUES


class DataQualityError(RuntimeError):
    """A rule that must hold was violated."""


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column  # NULL counts as violated

    def violations(self) -> Column:
        return F.count_if(~F.coalesce(self.holds, F.lit(False)))


# Accepted codes and labels, and the tested columns.
ACCEPTED_VALUES = {
    "vendor_id": (1, 2),
    "payment_type": (1, 2, 3, 4, 5, 6),
    "payment_type_label": ("credit_card", "cash", "no_charge", "dispute", "unknown"),
    "time_of_day": TIME_OF_DAY_VALUES,
}
NOT_NULL_COLUMNS = {
    "raw": ("vendor_id", "pickup_datetime", "dropoff_datetime"),
    "silver": (
        "vendor_id tpep_pickup_datetime tpep_dropoff_datetime trip_distance payment_type_label "
        "fare_amount total_amount time_of_day day_name is_weekend was_tipped"
    ).split(),
    "gold": (
        "pickup_date pickup_hour day_name is_weekend time_of_day trip_count total_revenue avg_fare "
        "is_peak_hour"
    ).split(),
}


def report(rows: DataFrame, rules: Iterable[Rule], not_empty: bool = False) -> DataFrame:
    """Evaluate all rules in one pass.

    An empty input passes every row rule; ``not_empty`` adds a rule it fails.
    """
    rules = list(rules)
    counted = rows.agg(
        F.count(F.lit(1)).alias("checked"),
        *[rule.violations().alias(f"v{i}") for i, rule in enumerate(rules)],
    )
    failures = {rule.name: F.col(f"v{i}") for i, rule in enumerate(rules)}
    if not_empty:
        failures = {"not_empty": (F.col("checked") == 0).cast("bigint"), **failures}
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), "checked", failed.alias("failed"))
            for name, failed in failures.items()
        ]
    )
    return counted.select(F.inline(lines)).withColumn("passed", F.col("failed") == 0)


def not_null_rules(columns: Iterable[str]) -> list[Rule]:
    return [Rule(f"not_null:{name}", F.col(name).isNotNull()) for name in columns]


def accepted_value_rules(values: Mapping[str, Iterable]) -> list[Rule]:
    """Listed values only; NULL is left to the not-null rules."""
    return [
        Rule(f"accepted_values:{name}", F.col(name).isNull() | F.col(name).isin(*allowed))
        for name, allowed in values.items()
    ]


def not_null_report(rows: DataFrame, layer: str) -> DataFrame:
    return report(rows, not_null_rules(NOT_NULL_COLUMNS[layer]))


def accepted_values_report(rows: DataFrame) -> DataFrame:
    return report(rows, accepted_value_rules(ACCEPTED_VALUES))


def non_positive_revenue(gold: DataFrame) -> DataFrame:
    """Gold rows that break the revenue rule; none is a pass."""
    return gold.filter(F.col("total_revenue") <= 0).select("pickup_date", "pickup_hour", "total_revenue")


def non_positive_duration(silver: DataFrame) -> DataFrame:
    """Silver rows whose duration or time order is wrong; none is a pass."""
    start, end = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    wrong = (F.col("trip_duration_minutes") <= 0) | (end <= start)
    return silver.filter(wrong).select(start, end, "trip_duration_minutes")


def _above_upto(column: str, low: float, high: float | None = None) -> Column:
    value = F.col(column)
    return value > low if high is None else (value > low) & (value <= high)


def _range_rules() -> dict[str, Rule]:
    """The rules the strict and demo reports share."""
    rules = (
        Rule("distance_range", _above_upto("trip_distance", 0, 200)),
        Rule("fare_range", _above_upto("fare_amount", 0, 500)),
        Rule("duration_range", _above_upto("trip_duration_minutes", 0, 300)),
        Rule("time_of_day_values", F.col("time_of_day").isin(*TIME_OF_DAY_VALUES)),
    )
    return {rule.name: rule for rule in rules}


def strict_rules() -> list[Rule]:
    """Ten rules.  Speed must stay below 120 although cleaning accepts exactly 120."""
    speed = F.col("avg_speed_mph")
    label = F.col("payment_type_label")
    shared = _range_rules()
    return [
        shared["distance_range"],
        shared["fare_range"],
        Rule("total_positive", F.col("total_amount") > 0),
        Rule("passenger_range", F.col("passenger_count").between(1, 9)),
        shared["duration_range"],
        Rule("speed_range", (speed > 0) & (speed < 120)),
        shared["time_of_day_values"],
        Rule("tip_pct_not_negative", F.col("tip_pct") >= 0),
        Rule("pickup_date_format", F.col("pickup_date").cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        Rule("payment_label_present", label.isNotNull() & (label != "")),
    ]


def demo_rules() -> list[Rule]:
    return list(_range_rules().values())


def sim_rules() -> list[Rule]:
    return [
        Rule("distance_positive", F.col("trip_distance") > 0),
        Rule("fare_positive", F.col("fare_amount") > 0),
        Rule("duration_positive", F.col("trip_duration_minutes") > 0),
    ]


def dbt_rules() -> list[Rule]:
    return not_null_rules(NOT_NULL_COLUMNS["silver"]) + accepted_value_rules(ACCEPTED_VALUES)


#: Row rules the silver table of each profile must satisfy (``spark`` has none).
SILVER_RULES = {"dbt": dbt_rules, "strict": strict_rules, "demo": demo_rules, "sim": sim_rules}

#: Profiles whose report also demands at least one row.
NON_EMPTY_PROFILES = frozenset({"sim"})


def silver_rules(profile: str) -> list[Rule]:
    return SILVER_RULES[profile]() if profile in SILVER_RULES else []


def gold_rules(profile: str) -> list[Rule]:
    """Rules of the hourly gold table; only the ``dbt`` profile has any."""
    if profile != "dbt":
        return []
    return [*not_null_rules(NOT_NULL_COLUMNS["gold"]), Rule("revenue_positive", F.col("total_revenue") > 0)]


def silver_report(silver: DataFrame, profile: str) -> DataFrame:
    """The profile's report over its silver table."""
    return report(silver, silver_rules(profile), not_empty=profile in NON_EMPTY_PROFILES)


def enforce(lines: DataFrame | list, message: str = "data quality") -> list:
    """Raise :class:`DataQualityError` when any line of a report failed.

    Collects the report, which has one row per rule.
    """
    rows = lines.collect() if isinstance(lines, DataFrame) else list(lines)
    broken = [f"{row['rule']} ({row['failed']} of {row['checked']})" for row in rows if not row["passed"]]
    if broken:
        raise DataQualityError(f"{message}: " + ", ".join(broken))
    return rows


def require_rows(**layers: DataFrame) -> None:
    """Raise when a layer has no rows."""
    empty = [name for name, rows in layers.items() if rows.isEmpty()]
    if empty:
        raise DataQualityError("empty layer: " + ", ".join(empty))
