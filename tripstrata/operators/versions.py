"""Queries over a versioned change log.

A change log holds one row per change: key and payload columns plus
``_version`` (commit number), ``_committed_at`` and ``_op`` (``U`` upsert, ``D``
delete).  Stored, it is partitioned by ``_version``, so version bounds prune
files.  Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upsert import dedupe_latest

VERSION, COMMITTED_AT, OP = "_version", "_committed_at", "_op"
META = (VERSION, COMMITTED_AT, OP)
UPSERT, DELETE = "U", "D"


def latest_changes(log: DataFrame, keys: Sequence[str], tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Newest change per key, deletes included."""
    return dedupe_latest(log, keys, [F.desc(VERSION), *tiebreak])


def current_rows(log: DataFrame, keys: Sequence[str], tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Live rows after all changes of the log."""
    return latest_changes(log, keys, tiebreak).filter(F.col(OP) != DELETE).drop(OP)


def _from_the_floor(log: DataFrame, column: str, bound: Column) -> Column:
    """True, or an error when the query runs if the whole log is newer than ``bound`` and was expired.

    An expired log begins with a base image at its oldest readable version, its floor; what was before is not known.
    One that still has version 1 is whole, and before it there was nothing.  The test is a scalar subquery of narrow
    columns, which runs whatever rows are left.
    """
    message = F.concat(F.lit(f"as of {column} "), bound.cast("string"), F.lit(" cannot be read: the log begins at "), F.min(column).cast("string"))
    return log.agg(F.when((F.min(column) > bound) & (F.min(VERSION) > 1), F.raise_error(message)).otherwise(F.lit(True))).scalar()


def as_of_version(log: DataFrame, keys: Sequence[str], version: int, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Live rows as they were right after ``version``; one before the floor of an expired log is an error."""
    bound = F.lit(version)
    known = log.filter((F.col(VERSION) <= version) & _from_the_floor(log, VERSION, bound))
    return current_rows(known, keys, tiebreak)


def as_of_timestamp(log: DataFrame, keys: Sequence[str], moment, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Live rows as they were at ``moment`` (inclusive); one before the floor of an expired log is an error."""
    bound = F.lit(moment).cast("timestamp_ntz")
    known = log.filter((F.col(COMMITTED_AT) <= bound) & _from_the_floor(log, COMMITTED_AT, bound))
    return current_rows(known, keys, tiebreak)


def version_history(log: DataFrame) -> DataFrame:
    """One row per version: commit time and number of changes by kind."""
    return log.groupBy(VERSION).agg(
        F.min(COMMITTED_AT).alias(COMMITTED_AT),
        F.count(F.lit(1)).alias("changes"),
        F.count_if(F.col(OP) == UPSERT).alias("upserts"),
        F.count_if(F.col(OP) == DELETE).alias("deletes"),
    )


def rollback_to_version(
    log: DataFrame, keys: Sequence[str], version: int, committed_at, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """Changes that, appended to the log, restore the rows of ``version``.

    Only keys changed after ``version`` can differ, so older history is first
    cut down to those keys.  Keys whose row is already as wanted get no change.
    """
    keys = list(keys)
    payload = [name for name in log.columns if name not in (*META, *keys)]
    since = log.filter(F.col(VERSION) > version)
    later = latest_changes(since, keys, tiebreak)
    earlier = log.filter(F.col(VERSION) <= version).join(since.select(*keys).distinct(), keys, "left_semi")
    before = current_rows(earlier, keys, tiebreak).select(
        *keys, F.struct(*payload).alias("_before"), F.lit(True).alias("_existed")
    )
    after = later.select(*keys, F.struct(*payload).alias("_after"), (F.col(OP) != DELETE).alias("_lives"))
    pair = after.join(before, keys, "left")

    existed = F.coalesce("_existed", F.lit(False))
    same = F.col("_lives") & F.col("_before").eqNullSafe(F.col("_after"))
    change = F.when(existed & ~same, F.lit(UPSERT)).when(~existed & F.col("_lives"), F.lit(DELETE))
    newest = log.agg(F.max(VERSION) + 1).scalar()
    restored = pair.withColumn(OP, change).filter(F.col(OP).isNotNull())
    row = F.when(F.col(OP) == UPSERT, F.col("_before")).otherwise(F.col("_after"))
    return restored.select(*keys, OP, row.alias("_row")).select(
        *keys,
        *[F.col("_row")[name].alias(name) for name in payload],
        newest.alias(VERSION),
        F.lit(committed_at).cast("timestamp_ntz").alias(COMMITTED_AT),
        OP,
    ).select(*log.columns)


def _commits(log: DataFrame) -> DataFrame:
    """One row per version with its first and last change time."""
    return log.groupBy(VERSION).agg(F.min(COMMITTED_AT).alias("_first"), F.max(COMMITTED_AT).alias("_last"))


def _bounds(log: DataFrame, older_than, retain_last: int) -> DataFrame:
    """One row ``bounds``: horizon, newest expired version and the time of its last change.

    All three come from one aggregate with an entry per version, so the rows are read once for them.
    """
    if retain_last < 1:
        raise ValueError("at least one version must be kept")
    history = _commits(log).agg(F.sort_array(F.collect_list(F.struct(VERSION, "_first", "_last"))).alias("all"))
    bound = F.lit(older_than).cast("timestamp_ntz")
    kept = F.concat(F.filter("all", lambda x: x["_first"] >= bound), F.reverse(F.slice(F.reverse("all"), 1, retain_last)))
    stays = history.select("all", F.array_min(F.transform(kept, lambda x: x[VERSION])).alias("horizon"))
    gone = stays.select("horizon", F.filter("all", lambda x: x[VERSION] < F.col("horizon")).alias("gone"))
    version = F.array_max(F.transform("gone", lambda x: x[VERSION]))
    last = F.array_max(F.transform("gone", lambda x: x["_last"]))
    return gone.select(F.struct("horizon", version.alias("version"), last.alias("last")).alias("bounds"))


def retention_horizon(log: DataFrame, older_than, retain_last: int = 3) -> DataFrame:
    """One row ``horizon``: the oldest version to keep.

    A version goes when it was committed before ``older_than`` and is not among
    the ``retain_last`` newest; the horizon is the smallest version that stays,
    so what goes is always a prefix of the history.
    """
    return _bounds(log, older_than, retain_last).select("bounds.horizon")


def expire_versions(
    log: DataFrame, keys: Sequence[str], older_than, retain_last: int = 3, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """The log without expired versions.

    What the expired versions left alive is folded into one base image under
    the newest expired version, so reads as of any kept version (or of the base)
    give the same rows as before.
    """
    bounds = _bounds(log, older_than, retain_last).scalar()
    horizon = bounds["horizon"]
    base = current_rows(log.filter(F.col(VERSION) < horizon), keys, tiebreak).withColumns(
        {
            VERSION: bounds["version"],
            COMMITTED_AT: bounds["last"],
            OP: F.lit(UPSERT),
        }
    )
    return base.select(*log.columns).unionByName(log.filter(F.col(VERSION) >= horizon))


def append_changes(rows: DataFrame, version: int, committed_at, op: str = UPSERT) -> DataFrame:
    """Turn plain rows into changes of one version, ready to append to a log."""
    return rows.withColumns(
        {
            VERSION: F.lit(version).cast("bigint"),
            COMMITTED_AT: F.lit(committed_at).cast("timestamp_ntz"),
            OP: F.lit(op),
        }
    )


def read_together(*tables: DataFrame) -> DataFrame:
    """Rows of tables with older and newer column sets; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
