"""Run records: one row per pipeline run."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import dedupe_latest
from ..sources.writers import write_parquet

AUDIT_SCHEMA = (
    "flow string, run_id string, status string, started_at timestamp_ntz, completed_at timestamp_ntz, "
    "rows_processed bigint, raw_rows bigint, silver_rows bigint, rejected_rows bigint, deduplicated_rows bigint, gold_rows bigint, notes string"
)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


@dataclass
class RunRecord:
    flow: str
    run_id: str
    started_at: dt.datetime
    status: str = "running"
    completed_at: dt.datetime | None = None
    rows_processed: int | None = None
    raw_rows: int | None = None
    silver_rows: int | None = None
    rejected_rows: int | None = None
    deduplicated_rows: int | None = None
    gold_rows: int | None = None
    notes: str | None = None

    def to_frame(self, spark: SparkSession) -> DataFrame:
        names = [part.split()[0] for part in AUDIT_SCHEMA.split(", ")]
        values = asdict(self)
        return spark.createDataFrame([tuple(values[name] for name in names)], AUDIT_SCHEMA)


def append_run(spark: SparkSession, record: RunRecord, path: str) -> None:
    """Add a run to the audit table: once when it starts (``running``) and once when it ends."""
    write_parquet(record.to_frame(spark), path, mode="append")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: how it ended, or that it started and was never heard of again."""
    rows = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    return dedupe_latest(rows, ["flow", "run_id"], [F.desc_nulls_last("completed_at")])
