"""Reading raw trips from CSV, Parquet, landed folders, tables and JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_number
from ..schemas import RAW_NAMES, RAW_SCHEMA, TRIP_NAMES

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA])


def to_trips(raw: DataFrame) -> DataFrame:
    """Rename raw columns to their operator names."""
    return raw.withColumnsRenamed(TRIP_NAMES)


def to_raw(trips: DataFrame) -> DataFrame:
    """Typed trips under their raw names, in raw column order."""
    return trips.withColumnsRenamed(RAW_NAMES).select(*RAW_SCHEMA.names)


def conform(raw: DataFrame) -> DataFrame:
    """Cast whatever types a source has to the raw schema and rename.

    Values that do not fit become NULL, columns the source lacks are NULL, and
    columns the schema lacks (such as layout partitions) are dropped.
    """
    have = dict(raw.dtypes)

    def typed(field: T.StructField):
        if field.name not in have:
            value = F.lit(None)
        elif have[field.name] in ("float", "double"):
            value = F.when(F.abs(F.col(field.name)) < float("inf"), F.col(field.name))  # not NaN either
        elif have[field.name] == "string" and isinstance(field.dataType, T.NumericType):
            return clean_number(field.name, field.dataType.simpleString()).alias(field.name)
        else:
            value = F.col(field.name)
        return value.try_cast(field.dataType).alias(field.name)

    return to_trips(raw.select(*[typed(field) for field in RAW_SCHEMA]))


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trips from CSV with a header; a cell that does not parse is NULL.

    The schema is fixed (no inference pass over the data); a header that does
    not match it is an error.
    """
    reader = (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
    )
    return to_trips(reader.csv(path))


def read_lenient_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trips from untidy CSV: trimmed cells, quotes, blank lines, short rows.

    An empty number counts as 0 and an empty flag as ``N``; text that is no
    number stays NULL and is rejected by cleaning.
    """
    return lenient_trips(read_text_csv(spark, path))


def read_text_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV cells as text under the names of the header, in whatever order it has them.

    All files of one call must have the same header; a file with another one is an error, never a column under
    the wrong name.
    """
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    reader = reader.options(**options)
    names = [name.strip() for name in reader.csv(path).columns]  # reads one line
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return reader.schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)


def lenient_trips(text: DataFrame) -> DataFrame:
    """Type a table of raw text columns as :func:`read_lenient_csv` does; absent columns count as empty cells."""
    have = set(text.columns)

    def typed(field: T.StructField):
        given = F.col(field.name) if field.name in have else F.lit(None).cast("string")
        cell = F.nullif(F.trim(given), F.lit(""))
        if isinstance(field.dataType, T.NumericType):
            filled = F.coalesce(cell, F.lit("0"))
            return clean_number(filled, field.dataType.simpleString()).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(cell, F.lit("N")).alias(field.name)
        return cell.try_cast(field.dataType).alias(field.name)

    return to_trips(text.select(*[typed(field) for field in RAW_SCHEMA]))


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trips from Parquet files, e.g. one file per month."""
    paths = [path] if isinstance(path, str) else list(path)
    return conform(spark.read.parquet(*paths))


def monthly_file(root: str, year: int, month: int) -> str:
    """Path of the monthly trip file below ``root``."""
    return f"{root.rstrip('/')}/yellow_tripdata_{year:04d}-{month:02d}.parquet"


def read_landed(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Trips from a landing folder that mixes CSV, JSON lines and Parquet files.

    Each format is read by its own reader, by column name.  ``first`` and ``last`` (ISO dates, inclusive) choose
    ingest days by the ``year=/month=[/day=]`` folders, so Spark lists and reads no others; a month's folder
    without days counts as its first day.
    """
    day = _landed_day()

    def chosen(frame: DataFrame) -> DataFrame:
        parts = {"year", "month"} <= set(frame.columns)
        if (first or last) and not parts:
            raise ValueError(f"{root} has no year=/month= folders to choose days from")
        if "day" not in frame.columns:
            frame = frame.withColumn("day", F.lit(1))
        for bound, keeps in ((first, day.__ge__), (last, day.__le__)):
            if bound:
                frame = frame.filter(keeps(F.to_date(F.lit(bound))))
        return frame

    readers = (
        lambda: conform(chosen(read_text_csv(spark, root, pathGlobFilter="*.csv*"))),
        lambda: conform(chosen(spark.read.schema(_TEXT_SCHEMA).option("pathGlobFilter", "*.json*").json(root))),
        lambda: conform(chosen(spark.read.option("pathGlobFilter", "*.parquet").parquet(root))),
    )
    present = [read() for glob, read in zip(("*.csv*", "*.json*", "*.parquet"), readers) if _has_files(spark, root, glob)]
    if not present:
        return conform(spark.createDataFrame([], _TEXT_SCHEMA))
    return reduce(DataFrame.unionByName, present)


def _landed_day():
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def _has_files(spark: SparkSession, root: str, glob: str) -> bool:
    """Whether any file below ``root`` has such a name (only names are listed)."""
    named = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return not named.select("path").limit(1).isEmpty()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_evolving_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files written with older and newer schemas, read as one table."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("mergeSchema", True).parquet(*paths)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        if partitions != 1:
            raise ValueError("parallel JDBC reads need a partition column")
        return options
    if lower is None or upper is None:
        raise ValueError("a partition column needs lower and upper bounds")
    return options | {
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Table of a relational database; see :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
