"""Ranks, rolling averages and top-n over aggregated tables.

Windows here run on gold rows (one per hour or zone), never on trips, and are
cut by day or hour; ranks over a whole table come from ranges and their counts.
Ties are broken by the key ascending, so ranks are the same on every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..sources.scratch import staged

# Peak-hour depth, rolling depth and revenue tiers.
PEAK_HOURS = 3
ROLLING_ROWS = 7
REVENUE_TIERS = ((10, "top_10"), (50, "top_50"), (100, "top_100"))
REVENUE_TIER_DEFAULT = "other"


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with as many underscores behind it as make it none of ``taken``, whatever the case of letters."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def rank_hours(hourly: DataFrame) -> DataFrame:
    """Rank the hours of each day and add the same-hour rolling average.

    The rolling window counts rows: a day without trips in that hour stretches
    it.  Windows are cut by date (at most 24 hours) and by hour (one row a day).
    """
    day, hour = Window.partitionBy("pickup_date"), F.col("pickup_hour")
    by_volume = F.row_number().over(day.orderBy(F.desc("trip_count"), hour))
    by_revenue = F.row_number().over(day.orderBy(F.desc("total_revenue"), hour))
    ranked = hourly.withColumns({"hour_rank_by_volume": by_volume, "hour_rank_by_revenue": by_revenue})
    return rolling_average(ranked).withColumn("is_peak_hour", F.col("hour_rank_by_volume") <= PEAK_HOURS)


def rolling_average(hourly: DataFrame) -> DataFrame:
    """Add the average trips of an hour over its last seven rows."""
    same_hour = Window.partitionBy("pickup_hour").orderBy("pickup_date").rowsBetween(1 - ROLLING_ROWS, 0)
    return hourly.withColumn("rolling_7d_avg_trips", X.round_half_up(F.avg("trip_count").over(same_hour), 1))


def with_position(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with their place in the total order of ``order``, from 0, as column ``name``.

    Rows are cut into ranges and sorted inside each, which needs no window and puts no more than a range into a
    task, also when many share the first column of the order.  A row's number inside its range and the rows of
    the ranges before make its place.  The sorted rows are staged, because ranges come from a sample: a second
    reading must see the same ones.  The driver sees one count a range.  Rows that are equal in all of ``order``
    stand side by side in any order.
    """
    return _placed(rows, order, name)[0]


def _placed(rows: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, int]:
    """As :func:`with_position`, and the number of rows."""
    at = free_name(rows.columns, "_at")
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    kept = staged(in_order, "in-order")
    # the id holds the number of the range above 33 bits and the row's number in it below
    part, inside = F.shiftright(at, 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    starts = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=-1) + 1)), initial=0))
    before = F.get(F.array(*[F.lit(s).cast("bigint") for s in starts]), part.cast("int"))
    return kept.withColumn(name, before + inside).drop(at), starts[-1]


def rank_zones(stats: DataFrame) -> DataFrame:
    """Rank zones against each other and add revenue percentile and tier.

    One row per ``location_id``, which may be NULL once.  Ties go to the smaller zone, NULL first.  The three
    orders are one sort by ranges, a row per zone and order, so no task sees all zones.
    """
    metrics = {"revenue_rank": "total_revenue", "volume_rank": "trip_count", "avg_fare_rank": "avg_fare"}
    zone, columns = F.col("location_id"), F.struct(*stats.columns)
    orders = [
        F.struct(F.lit(k).alias("k"), F.col(m).cast("double").alias("value"), F.when(F.lit(k == 0), columns).alias("zone_row"))
        for k, m in enumerate(metrics.values())
    ]
    long = stats.select("location_id", F.inline(F.array(*orders)))
    placed, rows = _placed(long, [F.col("k"), F.desc("value"), zone], "place")
    zones = rows // len(metrics)
    by_zone = placed.groupBy("location_id").agg(
        F.first("zone_row", ignorenulls=True).alias("zone_row"),
        *[F.max(F.when(F.col("k") == k, F.col("place"))).alias(name) for k, name in enumerate(metrics)],
    )
    # zones that earn as much as this one or more: the last place of those that earn the same
    same = placed.filter("k = 0").groupBy(F.col("value").alias("same_value")).agg((F.max("place") + 1).alias("at_least"))
    rank = F.col("revenue_rank")
    tier = F.coalesce(
        *[F.when(rank <= limit, F.lit(label)) for limit, label in REVENUE_TIERS],
        F.lit(REVENUE_TIER_DEFAULT),
    )
    counted = by_zone.join(same, F.col("zone_row.total_revenue").eqNullSafe(F.col("same_value")))
    behind = (zones - F.col("at_least")) * 100.0 / max(1, zones - 1)
    return counted.select(
        "zone_row.*",
        *[(F.col(name) - (k * zones - 1)).cast("int").alias(name) for k, name in enumerate(metrics)],
        X.round_half_up(behind, 1).alias("revenue_percentile"),
    ).withColumn("revenue_tier", tier)


def top_n(rows: DataFrame, order: Column | str, n: int, tiebreak: list[str]) -> DataFrame:
    """The ``n`` rows with the largest ``order``, ties by ``tiebreak`` ascending.

    Spark keeps the best ``n`` rows of every task and merges those.
    """
    key = F.col(order) if isinstance(order, str) else order
    return rows.orderBy(key.desc(), *tiebreak).limit(n)


def top_revenue_hours(gold: DataFrame, n: int = 5) -> DataFrame:
    """Best hours of an hourly gold table by revenue."""
    columns = ["pickup_date", "pickup_hour", "time_of_day", "trip_count", "total_revenue", "avg_fare"]
    keys = ["pickup_date", "pickup_hour"]
    for optional, into in (("pu_location_id", keys), ("tip_rate_pct", None)):
        if optional in gold.columns:
            columns.append(optional)
            if into is not None:
                into.append(optional)
    return top_n(gold.select(*columns), "total_revenue", n, keys)


def top_pickup_zones(zone_counts: DataFrame, n: int = 20) -> DataFrame:
    """Busiest pickup zones."""
    return top_n(zone_counts, "pickups", n, ["pu_location_id"])


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows; Spark reads only as many files as it takes."""
    return rows.limit(n)
