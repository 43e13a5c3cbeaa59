"""Table layout: partition columns, file listings, inventories and manifests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import DataQualityError

GRANULARITIES = ("hour", "day", "month", "year", "identity")


def partition_value(column: str, granularity: str = "day") -> Column:
    """Partition value of a timestamp at the given granularity.

    File tables partition on stored columns only, so the value is materialised:
    a date for day, month and year, a timestamp for hour, the column itself for
    anything else.
    """
    value = F.col(column)
    if granularity == "day":
        return F.to_date(value)
    if granularity in ("month", "year"):
        return F.trunc(F.to_date(value), granularity)
    if granularity == "hour":
        return F.date_trunc("hour", value).cast("timestamp_ntz")
    return value


def with_partition(rows: DataFrame, column: str, granularity: str = "day", name: str | None = None) -> DataFrame:
    """Add the partition column, named ``<column>_<granularity>`` unless given."""
    return rows.withColumn(name or f"{column}_{granularity}", partition_value(column, granularity))


def partition_counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per partition for hour, day, month and year granularity.

    The table is counted by hour once; coarser counts add up those hours.
    """
    hourly = rows.groupBy(partition_value(column, "hour").alias("_hour")).agg(F.count(F.lit(1)).alias("_rows"))
    grains = F.array(
        *[
            F.struct(
                F.lit(grain).alias("granularity"),
                partition_value("_hour", grain).cast("timestamp_ntz").alias("partition_start"),
            )
            for grain in ("hour", "day", "month", "year")
        ]
    )
    return (
        hourly.select("_rows", F.inline(grains))
        .groupBy("granularity", "partition_start")
        .agg(F.sum("_rows").alias("rows"))
    )


def partition_manifest(rows: DataFrame, partition: str = "pickup_date", order: str = "pickup_datetime") -> DataFrame:
    """Rows and value range per partition."""
    return rows.groupBy(partition).agg(
        F.count(F.lit(1)).alias("rows"), F.min(order).alias(f"min_{order}"), F.max(order).alias(f"max_{order}")
    )


def list_files(stored: DataFrame, *partition: str) -> DataFrame:
    """Data files behind a stored table: path, bytes and rows, one line per file.

    Reads file metadata only; no data column is scanned.
    """
    return (
        stored.select(
            *partition,
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .groupBy(*partition, "file_path", "bytes")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def stored_manifest(stored: DataFrame, partition: str = "pickup_date") -> DataFrame:
    """Files, bytes and rows per partition of a stored table."""
    return (
        list_files(stored, partition)
        .groupBy(partition)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    )


def layer_inventory(spark: SparkSession, layers: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Files, bytes and rows of each layer folder (layer name -> path).

    A layer without files is listed with zeros; :func:`require_layers` fails on it.
    """
    lines = []
    for name, path in layers.items():
        try:
            files = list_files(spark.read.format(fmt).load(path))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            files = spark.createDataFrame([], "file_path string, bytes bigint, rows bigint")
        lines.append(
            files.agg(
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            ).select(F.lit(name).alias("layer"), "files", "bytes", "rows")
        )
    inventory = lines[0]
    for line in lines[1:]:
        inventory = inventory.unionByName(line)
    return inventory


def require_layers(inventory: DataFrame) -> list:
    """Collect an inventory (one row per layer) and fail when a layer is empty."""
    rows = inventory.collect()
    empty = [row["layer"] for row in rows if row["files"] == 0 or row["bytes"] == 0]
    if empty:
        raise DataQualityError("empty layer: " + ", ".join(empty))
    return rows
