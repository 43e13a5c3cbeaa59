"""The layered run: raw trips -> silver -> quality gate -> gold -> inventory -> audit."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from ..operators.clean import REJECT_REASON, with_reject_reason
from ..operators.gold import GOLD_TABLES, stats_of_days, zone_days
from ..operators.history import TableHistory
from ..operators.ranking import rank_zones
from ..operators.refresh import changed_summary
from ..operators.silver import build_silver, newest_per_key
from ..operators.stored import finish_merge, merge_into_path
from ..operators.upsert import incremental_filter
from ..schemas import MERGE_KEYS
from ..sources import files
from ..sources.layout import layer_inventory, require_layers
from ..sources.writers import ensure_database, overwrite_partitions, register_table, write_json_lines, write_parquet
from .audit import RunRecord, append_run, utc_now

#: Raw trips lie in a folder for each outcome: accepted, or the rule that turned them away.
OUTCOME, ACCEPTED = "outcome", "accepted"
SORT_COLUMNS = {"dbt": ("tpep_pickup_datetime",)}


@dataclass
class RunResult:
    record: RunRecord
    quality: list = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    inventory: list = field(default_factory=list)


def _observed(silver: DataFrame, profile: str, name: str) -> tuple[DataFrame, Observation, list[str]]:
    """Attach rule counters, so that the write itself evaluates the quality rules.

    A task that runs again after an executor was lost may count twice.  That
    cannot hide a violation or invent one, and row numbers are taken from the
    written files instead.
    """
    rules = Q.silver_rules(profile)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [rule.violations().alias(f"v{i}") for i, rule in enumerate(rules)]
    observation = Observation(name)
    return silver.observe(observation, *metrics), observation, [rule.name for rule in rules]


def _report(metrics: dict, names: list[str], rows: int, not_empty: bool) -> list[dict]:
    failures = {name: metrics[f"v{i}"] for i, name in enumerate(names)}
    if not_empty:
        failures = {"not_empty": int(rows == 0), **failures}
    return [
        {"rule": name, "checked": rows, "failed": failed, "passed": failed == 0}
        for name, failed in failures.items()
    ]


def dry_run(spark: SparkSession, trips: DataFrame, profile: str, run_id: str | None = None) -> RunResult:
    """Compute everything, write nothing; gold tables are returned lazily."""
    record = RunRecord(f"medallion_{profile}", run_id or uuid.uuid4().hex, utc_now())
    silver = build_silver(trips, profile)
    counts = trips.agg(F.count(F.lit(1))).first()[0]
    rules = Q.silver_rules(profile)
    lines = Q.enforce(Q.silver_report(silver, profile)) if rules else []
    silver_rows = lines[0]["checked"] if lines else silver.count()
    record.raw_rows = record.rows_processed = counts
    record.silver_rows, record.rejected_rows = silver_rows, counts - silver_rows
    record.status, record.completed_at, record.notes = "success", utc_now(), "dry run"
    tables = {name: build(silver) for name, build in GOLD_TABLES[profile].items()}
    return RunResult(record, lines, {"silver": silver, **tables})


def run_medallion(
    spark: SparkSession,
    trips: DataFrame,
    profile: str,
    root: str,
    mode: str = "full",
    write: bool = True,
    lookback_days: int = 0,
    run_id: str | None = None,
    database: str | None = None,
) -> RunResult:
    """Run a profile end to end below ``root``.

    ``raw/<profile>/run_id=<id>`` takes the run's trips in the only pass over the source, a folder for each outcome:
    ``accepted`` or the first rule a trip fails.  What follows reads the accepted ones; row numbers come from the
    files.  ``full`` rebuilds ``silver/<profile>``; ``incremental`` (``dbt`` profile) takes trips from the newest
    loaded day on and upserts them.  Either way silver is written to a stage in a pass that also evaluates the rules,
    is put in place only when every rule holds, and becomes a version of its history (``operators/history.py``).

    ``gold/<profile>/<table>`` is rebuilt in full mode.  In incremental mode the history tells which days changed
    since gold was built, and only what depends on them is computed and replaced (``operators/refresh.py``).  With
    ``database``, the layers are tables of the catalog, too.
    """
    if not write:
        return dry_run(spark, trips, profile, run_id)
    root = root.rstrip("/")
    layout = Layout(root, profile)
    record = RunRecord(f"medallion_{profile}", run_id or uuid.uuid4().hex, utc_now())
    append_run(spark, record, layout.audit)  # a run whose driver dies stays visible as ``running``
    try:
        result = _write_layers(spark, trips, layout, mode, lookback_days, record)
        if database:
            register_layers(spark, database, layout)
        record.status = "success"
    except Exception as error:
        record.status, record.notes = "failed", str(error)
        raise
    finally:
        record.completed_at = utc_now()
        append_run(spark, record, layout.audit)
    return result


@dataclass(frozen=True)
class Layout:
    """Where the layers of a profile lie."""

    root: str
    profile: str

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/{self.profile}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.profile}"

    @property
    def zone_days(self) -> str:
        return f"{self.root}/gold_parts/{self.profile}/zone_days"

    @property
    def gold_version(self) -> str:
        return f"{self.root}/gold_parts/{self.profile}/silver_version"

    def manifest(self, run_id: str) -> str:
        return f"{self.root}/manifest/{self.profile}/run_id={run_id}"

    def gold(self) -> dict[str, str]:
        return {name: f"{self.root}/gold/{self.profile}/{name}" for name in GOLD_TABLES[self.profile]}


def _write_layers(spark, trips, layout, mode, lookback_days, record) -> RunResult:
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "incremental" and layout.profile != "dbt":
        raise ValueError("only the dbt profile has an incremental silver table")
    history = TableHistory(spark, layout.silver)
    files.recover(spark, f"{layout.silver}__staged", layout.silver)
    finish_merge(spark, layout.silver)  # before anything reads the table
    accepted = _land(spark, trips, layout, mode, lookback_days, record)
    write = _rebuild_silver if mode == "full" else _extend_silver
    lines = write(spark, accepted, layout, history, record)
    lines += _refresh_gold(spark, layout, history, mode)
    paths = layout.gold()
    tables = {"silver": spark.read.parquet(layout.silver), **{name: spark.read.parquet(path) for name, path in paths.items()}}
    record.gold_rows = sum(tables[name].count() for name in paths)  # from the file footers
    layers = {"silver": layout.silver, **{f"gold/{name}": path for name, path in paths.items()}}
    inventory = require_layers(layer_inventory(spark, layers))
    manifest = layer_inventory(spark, {"raw": f"{layout.raw}/run_id={record.run_id}", **layers})
    write_json_lines(manifest.withColumn("run_id", F.lit(record.run_id)).coalesce(1), layout.manifest(record.run_id))
    return RunResult(record, lines, tables, inventory)


def _land(spark, trips, layout, mode, lookback_days, record) -> DataFrame:
    """Write the run's trips by outcome, count them, and return the accepted ones.  Written again, a run's folder is replaced."""
    tagged = with_reject_reason(trips, layout.profile)
    if mode == "incremental":
        stored = spark.read.parquet(layout.silver) if files.exists(spark, layout.silver) else None
        tagged = incremental_filter(tagged, stored, lookback_days=lookback_days)
    target = f"{layout.raw}/run_id={record.run_id}"
    outcome = F.coalesce(REJECT_REASON, F.lit(ACCEPTED)).alias(OUTCOME)
    write_parquet(tagged.select(*trips.columns, outcome), target, partition_by=[OUTCOME], rebalance=False)
    kinds = T.StructType([*(T.StructField(f.name, f.dataType) for f in trips.schema), T.StructField(OUTCOME, T.StringType())])
    landed = spark.read.schema(kinds).parquet(target)
    counts = {row[OUTCOME]: row["count"] for row in landed.groupBy(OUTCOME).count().collect()}  # a row a rule
    record.raw_rows = record.rows_processed = sum(counts.values())
    record.rejected_rows = record.raw_rows - counts.get(ACCEPTED, 0)
    return landed.filter(F.col(OUTCOME) == ACCEPTED).drop(OUTCOME)


def write_checked(silver: DataFrame, profile: str, stage: str, name: str, **options) -> tuple[list[dict], int]:
    """Write silver rows to a stage; returns the report of the profile's rules, from the same pass, and the rows written."""
    observed, checks, names = _observed(silver, profile, name)
    write_parquet(observed, stage, **options)
    rows = silver.sparkSession.read.schema(silver.schema).parquet(stage).count()
    return _report(checks.get, names, rows, profile in Q.NON_EMPTY_PROFILES), rows


def _stage_silver(silver, stage, layout, record, **options) -> tuple[list[dict], int]:
    lines, rows = write_checked(silver, layout.profile, stage, f"silver_{record.run_id}", **options)
    record.silver_rows, record.deduplicated_rows = rows, record.raw_rows - record.rejected_rows - rows
    return lines, rows


def _rebuild_silver(spark, accepted, layout, history, record) -> list[dict]:
    built = build_silver(accepted, layout.profile)
    if layout.profile == "dbt":
        built = newest_per_key(built)  # the rule of the incremental mode
    stage, order = f"{layout.silver}__staged", SORT_COLUMNS.get(layout.profile, ("pickup_datetime",))
    lines, _ = _stage_silver(built, stage, layout, record, partition_by=["pickup_date"], sort_by=order)
    Q.enforce(lines, f"silver of profile {layout.profile} not published")
    history.commit(stage, "rebuild", replace=True)
    return lines


def _extend_silver(spark, accepted, layout, history, record) -> list[dict]:
    updates, stage = newest_per_key(build_silver(accepted, "dbt")), f"{layout.silver}__updates"
    lines, rows = _stage_silver(updates, stage, layout, record)
    Q.enforce(lines, "updates not merged")
    if rows or not files.exists(spark, layout.silver):
        merge_into_path(spark, layout.silver, spark.read.parquet(stage), MERGE_KEYS, check=False, history=True)
    files.delete(spark, stage)
    return lines


def _built_version(spark, layout) -> int:
    if not files.is_complete(spark, layout.gold_version):
        return 0
    return spark.read.parquet(layout.gold_version).first()[0]


def _refresh_gold(spark, layout, history, mode) -> list[dict]:
    """Bring gold up to the newest version of silver and note that version; a run that stops before it starts again there."""
    paths, built, newest = layout.gold(), _built_version(spark, layout), history.newest()
    silver = spark.read.parquet(layout.silver)
    known = built >= max(history.floor(), 1) and all(files.exists(spark, path) for path in [*paths.values(), layout.zone_days])
    for path in [*paths.values(), layout.zone_days]:
        files.recover(spark, f"{path}__staged", path)
    if mode == "full" or layout.profile != "dbt" or not known:
        lines = _rebuild_gold(spark, layout, silver)
    elif newest > built:
        # one row per changed day
        touched = sorted(row[0] for row in history.changes(built).select("pickup_date").distinct().collect())
        lines = _update_gold(spark, layout, silver, touched) if touched else []
    else:
        lines = []
    spark.createDataFrame([(newest,)], "silver_version bigint").coalesce(1).write.mode("overwrite").parquet(layout.gold_version)
    return lines


def _gold_checked(spark, layout, stage) -> list[dict]:
    rules = Q.gold_rules(layout.profile)
    if not rules:
        return []
    staged = spark.read.schema(spark.read.parquet(stage).schema).parquet(stage)
    return [row.asDict() for row in Q.enforce(Q.report(staged, rules), "gold not published")]


def _rebuild_gold(spark, layout, silver) -> list[dict]:
    paths, tables = layout.gold(), dict(GOLD_TABLES[layout.profile])
    if layout.profile == "dbt":
        write_parquet(zone_days(silver), f"{layout.zone_days}__staged", partition_by=["pickup_date"])
        days = spark.read.parquet(f"{layout.zone_days}__staged")
        tables["location_performance"] = lambda _: rank_zones(stats_of_days(days))
    for name, build in tables.items():
        by_day = ["pickup_date"] if name == "daily_summary" else []
        write_parquet(build(silver), f"{paths[name]}__staged", partition_by=by_day)
    lines = _gold_checked(spark, layout, f"{paths['daily_summary']}__staged") if "daily_summary" in paths else []
    for path in paths.values():  # all tables are written and checked: put them in place
        files.publish(spark, f"{path}__staged", path)
    if layout.profile == "dbt":
        files.publish(spark, f"{layout.zone_days}__staged", layout.zone_days)
    return lines


def _update_gold(spark, layout, silver, touched) -> list[dict]:
    paths = layout.gold()
    summary, zones = paths["daily_summary"], paths["location_performance"]
    rows, days = changed_summary(spark.read.parquet(summary), silver, touched)
    write_parquet(rows, f"{summary}__changed", partition_by=["pickup_date"])
    staged = spark.read.schema(rows.schema).parquet(f"{summary}__changed")
    filled = {row[0] for row in staged.select("pickup_date").distinct().collect()}  # a row a changed day
    lines = _gold_checked(spark, layout, f"{summary}__changed") if filled else []
    of_days = silver.filter(F.col("pickup_date").isin(touched))
    overwrite_partitions(zone_days(of_days), layout.zone_days, ["pickup_date"])
    overwrite_partitions(staged, summary, ["pickup_date"], rebalance=False)
    files.delete(spark, f"{summary}__changed")
    for day in set(days) - filled:  # no trips are left
        for path in (summary, layout.zone_days):
            files.delete(spark, f"{path}/pickup_date={day}")
    write_parquet(rank_zones(stats_of_days(spark.read.parquet(layout.zone_days))), f"{zones}__staged")
    files.publish(spark, f"{zones}__staged", zones)
    return lines


def register_layers(spark: SparkSession, database: str, layout: Layout) -> list[str]:
    """Tables of the catalog over the stored layers, which they read where they are; returns their names."""
    ensure_database(spark, database)
    layers = {f"raw_{layout.profile}": layout.raw, f"silver_{layout.profile}": layout.silver}
    layers |= {f"gold_{layout.profile}_{name}": path for name, path in layout.gold().items()}
    for name, path in layers.items():
        register_table(spark, f"`{database}`.`{name}`", path)
    return sorted(layers)
