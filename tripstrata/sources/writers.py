"""Writing Parquet, JSON lines, landed raw files and catalog tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

# Write properties.
COMPRESSION = "zstd"
TARGET_FILE_BYTES = 134_217_728
#: Safety bound on rows per file, for sessions without AQE.
MAX_RECORDS_PER_FILE = 5_000_000


def balanced(rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Spread rows over tasks for writing.

    The rebalance hint brings rows of a table partition together and lets AQE
    split large and merge small pieces at the advisory size, so a hot day
    becomes several files instead of one slow task.
    """
    return rows.hint("rebalance", *partition_by) if partition_by else rows.hint("rebalance")


def _writer(
    rows: DataFrame, partition_by: Sequence[str], mode: str, sort_by: Sequence[str], rebalance: bool
) -> DataFrameWriter:
    spread = balanced(rows, partition_by) if rebalance else rows
    if sort_by:
        spread = spread.sortWithinPartitions(*partition_by, *sort_by)
    writer = spread.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    rows: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Write Parquet (zstd) with a fixed column order."""
    selected = rows.select(*columns) if columns else rows
    _writer(selected, partition_by, mode, sort_by, rebalance).option("compression", COMPRESSION).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True) -> None:
    """Replace exactly the table partitions that occur in ``rows``.

    Without ``rebalance`` rows are written as they are laid out, with no shuffle.
    """
    writer = _writer(rows, partition_by, "overwrite", (), rebalance)
    writer.option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION).parquet(path)


def write_json_lines(rows: DataFrame, path: str, gzip: bool = False, mode: str = "overwrite") -> None:
    """Write one JSON object per line, optionally gzip-compressed."""
    writer = rows.write.mode(mode)
    (writer.option("compression", "gzip") if gzip else writer).json(path)


def land_raw(raw: DataFrame, root: str, day: dt.date, daily: bool = True, fmt: str = "csv") -> None:
    """Append raw rows below ``year=/month=[/day=]`` of the landing root.

    The folder is the ingest day, not the pickup day of the rows.
    """
    folder = f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}"
    if daily:
        folder += f"/day={day:%d}"
    writer = raw.write.mode("append")
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(folder)
    elif fmt == "jsonl":
        writer.option("compression", "gzip").json(folder)
    else:
        writer.option("compression", COMPRESSION).parquet(folder)


def write_table(
    rows: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
) -> None:
    """Create or replace a catalog table; no ``partition_by`` gives an unpartitioned one."""
    writer = _writer(rows, partition_by, mode, sort_by, True)
    writer.format("parquet").option("compression", COMPRESSION).saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make the Parquet folder ``path`` the table ``name`` of the catalog, with the partitions it holds now.

    The table is a name for the folder: making it again, or dropping it, leaves the files alone.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name.replace("`", ""), path=path, source="parquet")
    if spark.sql(f"DESCRIBE {name}").filter("col_name = '# Partition Information'").count():
        spark.catalog.recoverPartitions(name.replace("`", ""))


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Stored tables of a database; temporary views, which Spark lists everywhere, are left out."""
    listed = spark.sql(f"SHOW TABLES IN `{database}`").filter(~F.col("isTemporary"))
    return listed.select(F.col("namespace").alias("database"), F.col("tableName").alias("table"))
