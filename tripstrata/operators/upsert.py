"""Keyed upsert, ingest dedupe and incremental selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: first date loaded when the target is still empty.
FIRST_DATE = "2019-01-01"


def dedupe_latest(rows: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first in ``latest`` order.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle, so every task sends at most one row per key and a key holding a
    large part of the table does not pile up in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*latest)
    return rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") == 1).drop("_nth")


def dedupe_updates(rows: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """:func:`dedupe_latest` for rows to be merged: a NULL in the key equals nothing, so such rows all stay.

    Each of them forms a group of its own, which also spreads them over the tasks.
    """
    incomplete = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    apart = rows.withColumn("_apart", F.when(incomplete, F.monotonically_increasing_id()))
    return dedupe_latest(apart, [*keys, "_apart"], latest).drop("_apart")


def incremental_extract(
    rows: DataFrame, keys: Sequence[str], replication_key: str, bookmark, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """Newest row per key among those changed since ``bookmark``.

    The bound is inclusive: rows stamped exactly with the bookmark come again,
    and the key dedupe downstream absorbs them.
    """
    fresh = rows.filter(F.col(replication_key) >= F.lit(bookmark)) if bookmark is not None else rows
    return dedupe_latest(fresh, keys, [F.desc(replication_key), *tiebreak])


def next_bookmark(rows: DataFrame, replication_key: str) -> DataFrame:
    """One row with the bookmark the next extract starts from."""
    return rows.agg(F.max(replication_key).alias("bookmark"))


def watermark(target: DataFrame, column: str = "pickup_date", default: str = FIRST_DATE) -> DataFrame:
    """One row: newest ``column`` of the target, or ``default`` for an empty one."""
    return target.agg(F.coalesce(F.max(column), F.to_date(F.lit(default))).alias("watermark"))


def incremental_filter(
    source: DataFrame,
    target: DataFrame | None,
    column: str = "pickup_date",
    default: str = FIRST_DATE,
    lookback_days: int = 0,
) -> DataFrame:
    """Source rows on or after the target's newest ``column``.

    Rows dated before it are skipped, so late data is lost unless
    ``lookback_days`` widens the range.  The bound is a scalar subquery: it
    runs first and then prunes partitions of the source like a literal.
    With ``target=None`` (first load, full refresh) everything passes.
    """
    if target is None:
        return source
    newest = watermark(target, column, default)
    if lookback_days:
        newest = newest.select(F.date_sub("watermark", lookback_days))
    return source.filter(F.col(column) >= newest.scalar())


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    latest: Sequence[Column] | None = None,
    check: bool = True,
) -> DataFrame:
    """Replace target rows whose key occurs in ``updates``; add all updates.

    A NULL in the key never matches, so such rows are added every time.  Two
    updates with one key are ambiguous.  With ``latest`` the first in that
    order wins; without it the query fails when it runs (``check=False`` skips
    that test for updates known to be unique).

    The target meets only the distinct keys of the updates, so a key repeated in
    the updates is one row there; a hot key in the target is on the side of the
    anti-join that AQE can split.  AQE broadcasts the keys when their measured
    size allows.
    """
    keys = list(keys)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    if latest is not None:
        updates = dedupe_updates(updates, keys, latest)
    elif check:
        repeated = (
            updates.na.drop(subset=keys)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .agg(F.count(F.lit(1)))
            .scalar()
        )
        message = F.lit(f"merge_upsert: several updates for one key ({', '.join(keys)}); dedupe first")
        updates = updates.filter(F.when(repeated > 0, F.raise_error(message)).otherwise(F.lit(True)))
    return kept.unionByName(updates.select(*target.columns))
