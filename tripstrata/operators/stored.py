"""Upsert and maintenance of tables stored as partitioned Parquet folders."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from ..sources.layout import stored_manifest
from ..sources.writers import TARGET_FILE_BYTES, overwrite_partitions, write_parquet
from . import versions as V
from .history import TableHistory
from .upsert import merge_upsert


def _stage(path: str) -> str:
    """Folder next to the table, hence on the same shared storage."""
    return f"{path.rstrip('/')}__merging"


def finish_merge(spark: SparkSession, path: str, partition: str = "pickup_date", history: bool = False) -> bool:
    """Complete a merge that stopped between staging and publishing.

    The stage holds the merged partitions in full, so publishing it again is
    safe however far the first attempt got.  With ``history``, and for a table
    that has one, it becomes a version.  Returns True when there was one.
    """
    stage, versions = _stage(path), TableHistory(spark, path, partition)
    history = history or files.exists(spark, versions.folder)
    done = versions.finish() if history else False
    pending = files.is_complete(spark, stage)
    if pending and history:
        fresh = not files.exists(spark, path)
        versions.commit(stage, "load" if fresh else "merge", replace=fresh)
    elif pending:
        overwrite_partitions(spark.read.parquet(stage), path, [partition], rebalance=False)
    if files.exists(spark, stage):
        files.delete(spark, stage)
    return pending or done


def merge_into_path(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition: str = "pickup_date",
    check: bool = True,
    history: bool = False,
) -> None:
    """Upsert ``updates`` into the table at ``path``, rewriting only the partitions they touch.

    The key must fix the partition (it holds the pickup time), so untouched
    partitions cannot hold a match.  Steps: write the merged partitions to a
    stage, overwrite those partitions from it, drop the stage.  Whatever step
    fails, running the same merge again gives the same table.  With ``history``,
    and for a table that has one, the merge is a version of it.
    """
    finish_merge(spark, path, partition)
    if not files.exists(spark, path):  # first load takes rows as they are
        write_parquet(updates, _stage(path) if history else path, partition_by=[partition])
        if history:
            finish_merge(spark, path, partition, history)
        return
    updates = updates.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # one value per day in the updates
        touched = [row[0] for row in updates.select(partition).distinct().collect()]
        if not touched:
            return
        target = spark.read.parquet(path).filter(F.col(partition).isin(touched))
        merged = merge_upsert(target, updates, keys, check=check)
        write_parquet(merged, _stage(path), partition_by=[partition])
    finally:
        updates.unpersist()
    finish_merge(spark, path, partition, history)


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    """Change log stored with ``_version`` folders; version bounds prune files."""
    stored = spark.read.parquet(path)
    others = [name for name in stored.columns if name not in V.META]
    return stored.select(*others, F.col(V.VERSION).cast("bigint").alias(V.VERSION), V.COMMITTED_AT, V.OP)


def append_to_log(changes: DataFrame, path: str) -> None:
    write_parquet(changes, path, partition_by=[V.VERSION], mode="append")


def expire_stored_log(
    spark: SparkSession, path: str, keys: Sequence[str], older_than, retain_last: int = 3, tiebreak: Sequence[Column] = ()
) -> None:
    """Replace a stored log by :func:`versions.expire_versions` of it."""
    stage = f"{path.rstrip('/')}__expiring"
    files.recover(spark, stage, path)
    kept = V.expire_versions(read_change_log(spark, path), keys, older_than, retain_last, tiebreak)
    write_parquet(kept, stage, partition_by=[V.VERSION])
    files.publish(spark, stage, path)


def compact(
    spark: SparkSession,
    path: str,
    partition: str = "pickup_date",
    sort_by: Sequence[str] = ("pickup_datetime",),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite partitions that hold more files than their size needs; rows stay the same.

    Each of them gets as many files as target sizes fit into it, at least one, so a second run finds nothing to
    do; files are sorted.  A large partition's rows are dealt to its files by hash, so no task gets all of it.
    Returns files, bytes and rows per rewritten partition before and after.
    """
    finish_merge(spark, path, partition)
    needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
    manifest = stored_manifest(spark.read.parquet(path), partition)
    # one row per partition folder with more files than needed
    crowded = manifest.filter(F.col("files") > needed).collect()
    before = spark.createDataFrame(crowded, manifest.schema)
    if not crowded:
        empty = before.withColumnsRenamed({name: f"{name}_before" for name in ("files", "bytes", "rows")})
        return empty.withColumns({f"{name}_after": F.lit(None).cast("bigint") for name in ("files", "bytes", "rows")})
    pieces = {row[partition]: max(1, round(row["bytes"] / target_bytes)) for row in crowded}
    rows = spark.read.parquet(path)
    of_partition = spark.createDataFrame(list(pieces.items()), T.StructType([rows.schema[partition], T.StructField("_pieces", T.LongType())]))
    dealt = rows.join(of_partition, partition).withColumn("_piece", F.pmod(F.xxhash64(*rows.columns), "_pieces"))
    # in the order of (partition, piece), so that two files of one partition seldom meet in a task and become one
    spread = dealt.repartitionByRange(sum(pieces.values()), partition, "_piece").select(*rows.columns)
    write_parquet(spread, _stage(path), partition_by=[partition], sort_by=sort_by, rebalance=False)
    staged = spark.read.parquet(_stage(path))
    if staged.count() != sum(row["rows"] for row in crowded):
        raise RuntimeError(f"compaction of {path} lost rows; table left as it was")
    if max(pieces.values()) > 1:  # reading would pack small files together
        staged = staged.repartition(sum(pieces.values()), F.input_file_name()).sortWithinPartitions(partition, *sort_by)
    overwrite_partitions(staged, path, [partition], rebalance=False)
    files.delete(spark, _stage(path))
    after = stored_manifest(spark.read.parquet(path), partition)
    pairs = before.alias("b").join(after.alias("a"), partition)
    return pairs.select(
        partition,
        *[F.col(f"b.{name}").alias(f"{name}_before") for name in ("files", "bytes", "rows")],
        *[F.col(f"a.{name}").alias(f"{name}_after") for name in ("files", "bytes", "rows")],
    )


def run_maintenance(spark: SparkSession, tasks: dict[str, Callable[[], object]]) -> DataFrame:
    """Run one maintenance task per table; a failure is recorded and the others still run."""
    results = []
    for table, task in tasks.items():
        try:
            task()
            results.append(Row(table=table, status="success", message=None))
        except Exception as error:  # the next table must not suffer
            results.append(Row(table=table, status="failed", message=str(error)))
    return spark.createDataFrame(results, "table string, status string, message string")
