"""Incremental ingest of landed files with Structured Streaming.

Each file is read once; the checkpoint remembers which.  Runs use the
``availableNow`` trigger: process what has landed, then stop, as a daily job does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality as Q
from ..operators.clean import REJECT_REASON, with_reject_reason
from ..operators.silver import build_silver, newest_per_key
from ..operators.stored import merge_into_path
from ..plans.audit import RunRecord, append_run, utc_now
from ..plans.medallion import write_checked
from ..schemas import MERGE_KEYS, RAW_SCHEMA
from ..session import shared_folder
from ..sources import files
from ..sources.readers import conform, lenient_trips
from ..sources.writers import write_parquet

_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA])


def landed_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of typed trips from CSV, JSON-lines and Parquet files below ``landing``.

    A stream's columns are fixed when it starts, so CSV headers must be those of the raw schema, in its order; a
    file with another header stops the stream instead of putting cells under wrong names.
    """

    def reader(glob: str, schema: T.StructType):
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        return stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else stream

    csv = reader("*.csv*", _TEXT_SCHEMA).option("header", True).option("enforceSchema", False)
    csv = csv.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(landing)
    lines = reader("*.json*", _TEXT_SCHEMA).json(landing)
    return lenient_trips(csv).unionByName(lenient_trips(lines)).unionByName(conform(reader("*.parquet", RAW_SCHEMA).parquet(landing)))


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str) -> str:
    return checkpoint or f"{shared_folder(spark)}/streams/{name}"


def ingest_landing(
    spark: SparkSession, landing: str, raw_path: str, checkpoint: str | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append newly landed trips to the raw Parquet table; each file exactly once."""
    writer = landed_stream(spark, landing, files_per_batch).writeStream.format("parquet").outputMode("append")
    return (
        writer.option("path", raw_path)
        .option("checkpointLocation", _checkpoint(spark, checkpoint, "ingest"))
        .trigger(availableNow=True)
        .start()
    )


def upsert_batch(silver_path: str, rejects_path: str | None = None, audit_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """Handler that cleans a micro-batch, keeps its rejects, and merges the rest into the silver table.

    Rejected trips go to ``<rejects>/stream=<query>/batch_id=<n>`` with the rule that turned them away; accepted ones
    are staged in a pass that evaluates the silver rules, and merged when all hold.  A batch that breaks a rule stops
    the stream with silver as it was.  Merging is by key and a batch's rejects replace those of an earlier delivery, so
    a batch that comes again changes nothing.  Within a batch the last trip per key wins.  Each batch is a run in the
    audit.
    """
    rejects_path = rejects_path or f"{silver_path.rstrip('/')}__rejects"

    def handle(trips: DataFrame, batch_id: int) -> None:
        spark = trips.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        record = RunRecord("stream_to_silver", f"{stream}/{batch_id}", utc_now())
        tagged = with_reject_reason(trips, "dbt").select(*trips.columns, REJECT_REASON).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _merge_batch(spark, tagged, silver_path, f"{rejects_path}/stream={stream}/batch_id={batch_id}", record)
            record.status = "success"
        except Exception as error:
            record.status, record.notes = "failed", str(error)
            raise
        finally:
            tagged.unpersist()
            record.completed_at = utc_now()
            if audit_path:
                append_run(spark, record, audit_path)

    return handle


def _merge_batch(spark: SparkSession, tagged: DataFrame, silver_path: str, rejects: str, record: RunRecord) -> None:
    write_parquet(tagged.filter(F.col(REJECT_REASON).isNotNull()), rejects)
    record.rejected_rows = spark.read.parquet(rejects).count()  # from the file footers
    record.raw_rows = record.rows_processed = tagged.count()
    accepted = tagged.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)
    stage = f"{silver_path.rstrip('/')}__batch"
    lines, record.silver_rows = write_checked(newest_per_key(build_silver(accepted, "dbt")), "dbt", stage, f"batch {record.run_id}")
    record.deduplicated_rows = record.raw_rows - record.rejected_rows - record.silver_rows
    Q.enforce([line for line in lines if line["rule"] != "not_empty"], f"batch {record.run_id} not merged")
    if record.silver_rows:
        merge_into_path(spark, silver_path, spark.read.parquet(stage), MERGE_KEYS, check=False)
    files.delete(spark, stage)


def stream_to_silver(
    spark: SparkSession,
    landing: str,
    silver_path: str,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
    rejects_path: str | None = None,
    audit_path: str | None = None,
) -> StreamingQuery:
    """Clean newly landed trips, keep the rejects, and upsert the others into the silver table."""
    return (
        landed_stream(spark, landing, files_per_batch)
        .writeStream.foreachBatch(upsert_batch(silver_path, rejects_path, audit_path))
        .option("checkpointLocation", _checkpoint(spark, checkpoint, "silver"))
        .trigger(availableNow=True)
        .start()
    )
