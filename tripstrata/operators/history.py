"""Version history of a stored table: each publish is a version whose rows can be read again.

Beside the table lies a log of signed row counts: for each version the rows whose number of copies changed, with the
difference (``_delta``, positive for rows that came, negative for rows that went).  The rows of a version are those
whose differences add up to more than zero, so reading as of a version, expiring old ones and rolling back are all
one grouped sum.  It holds for tables with repeated rows, NULL keys or no keys at all.

A commit goes through these steps, and whichever of them fails, :meth:`TableHistory.finish` ends or undoes it before
the table is used again: the caller writes a complete stage; a note names it; the differences between table and
stage are written; a commit row makes them count; the stage is put in place; the note goes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.writers import overwrite_partitions, write_parquet

VERSION, COMMITTED_AT, DELTA = "_version", "_committed_at", "_delta"


def differences(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Rows with another number of copies in ``after`` than in ``before``, and the difference.

    Copies are summed in each task before the shuffle, and rows that stay the same end there.
    """
    columns = after.columns
    sides = [after.withColumn(DELTA, F.lit(1))]
    if before is not None:
        sides.append(before.select(*columns).withColumn(DELTA, F.lit(-1)))
    both = reduce(DataFrame.unionByName, sides)
    return both.groupBy(*columns).agg(F.sum(DELTA).alias(DELTA)).filter(F.col(DELTA) != 0)


def rows_of(log: DataFrame) -> DataFrame:
    """The rows that a log of differences adds up to, repeated rows repeated."""
    columns = [name for name in log.columns if name not in (VERSION, DELTA)]
    alive = log.groupBy(*columns).agg(F.sum(DELTA).alias(DELTA)).filter(F.col(DELTA) > 0)
    return alive.withColumn(DELTA, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(DELTA)))).drop(DELTA)


class TableHistory:
    """Versions of the table at ``path``, partitioned by ``partition`` (or not at all)."""

    def __init__(self, spark: SparkSession, path: str, partition: str | None = "pickup_date"):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.folder = f"{self.path}__history"

    # ---- reading ------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per version that can be read: number, time, operation, rows added and removed."""
        stored = f"{self.folder}/commits"
        schema = f"{COMMITTED_AT} timestamp_ntz, operation string, added bigint, removed bigint, {VERSION} bigint"
        if not files.exists(self.spark, stored):
            return self.spark.createDataFrame([], schema).select(VERSION, COMMITTED_AT, "operation", "added", "removed")
        found = self.spark.read.schema(schema).parquet(stored)
        return found.select(VERSION, COMMITTED_AT, "operation", "added", "removed").filter(F.col(VERSION) >= self.floor())

    def operations(self) -> list[str]:
        """What the versions were made by, oldest first."""
        return [row["operation"] for row in self.commits().orderBy(VERSION).collect()]

    def floor(self) -> int:
        """The oldest version that can be read; 0 before the first commit or expiry."""
        stored = f"{self.folder}/floors"
        if not files.exists(self.spark, stored):
            return 0
        return self.spark.read.parquet(stored).agg(F.max("floor")).first()[0] or 0

    def newest(self) -> int:
        """The newest version; 0 when there is none."""
        return self.commits().agg(F.max(VERSION)).first()[0] or 0

    def as_of(self, version: int) -> DataFrame:
        """The table's rows right after ``version``.  A version that is gone, or is not there yet, is an error."""
        known = self.commits().agg(F.min(VERSION), F.max(VERSION)).first()  # one row
        if known[0] is None or not known[0] <= version <= known[1]:
            raise ValueError(f"version {version} of {self.path} cannot be read: versions {known[0]} to {known[1]} are kept")
        return rows_of(self._log(version))

    def as_of_time(self, moment: dt.datetime) -> DataFrame:
        """The table's rows as they were at ``moment``; a moment before the oldest kept version is an error."""
        bound = F.lit(moment).cast("timestamp_ntz")
        version = self.commits().filter(F.col(COMMITTED_AT) <= bound).agg(F.max(VERSION)).first()[0]
        if version is None:
            raise ValueError(f"{self.path} cannot be read as of {moment}: its oldest kept version is younger")
        return self.as_of(version)

    def changes(self, after: int, to: int | None = None) -> DataFrame:
        """What changed behind version ``after``, up to ``to``: rows with ``_delta`` and ``_version``."""
        to = self.newest() if to is None else to
        return self._read("changes").filter((F.col(VERSION) > after) & (F.col(VERSION) <= to))

    def _read(self, kind: str) -> DataFrame:
        found = self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/{kind}")
        return found.withColumn(VERSION, F.col(VERSION).cast("bigint"))

    def _log(self, version: int) -> DataFrame:
        floor = self.floor()
        if not floor:
            return self._read("changes").filter(F.col(VERSION) <= version)
        base = self._read("base").filter(F.col(VERSION) == floor)
        if version == floor:
            return base
        later = self._read("changes").filter((F.col(VERSION) > floor) & (F.col(VERSION) <= version))
        return base.unionByName(later, allowMissingColumns=True)

    # ---- writing ------------------------------------------------------------------

    @cached_property
    def _note(self) -> str:
        return f"{self.folder}/pending"

    def commit(self, stage: str, operation: str, replace: bool, emptied: Sequence[str] = (), moment: dt.datetime | None = None) -> int:
        """Make the complete folder ``stage`` the next version of the table, and return its number.

        ``replace`` puts it in the table's place; otherwise it replaces the partitions it holds and those of ``emptied``
        go.  A table that was there before its history starts as version 1.
        """
        moment = moment or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        version = self.newest() + 1
        if version == 1 and files.exists(self.spark, self.path):
            self._record(1, self.spark.read.parquet(self.path), None, "import", moment)
            version = 2
        note = Row(version=version, stage=stage, operation=operation, replace=replace, emptied=list(emptied), moment=moment.isoformat())
        schema = "version bigint, stage string, operation string, replace boolean, emptied array<string>, moment string"
        self.spark.createDataFrame([note], schema).coalesce(1).write.mode("overwrite").parquet(self._note)
        self.finish()
        return version

    def finish(self) -> bool:
        """End a commit that was interrupted; True when there was one."""
        if not files.is_complete(self.spark, self._note):
            return False
        note = self.spark.read.parquet(self._note).first()
        if files.is_complete(self.spark, note["stage"]):
            if note["version"] > self.newest():  # nothing is put in place before its commit row is there
                after = self._staged(note)
                before = self._before(after, note)
                self._record(note["version"], after, before, note["operation"], dt.datetime.fromisoformat(note["moment"]))
            self._publish(note)
        files.delete(self.spark, self._note)
        return True

    def _staged(self, note: Row) -> DataFrame:
        """The stage's rows; one that replaces partitions may hold none."""
        reader = self.spark.read if note["replace"] else self.spark.read.schema(self.spark.read.parquet(self.path).schema)
        return reader.parquet(note["stage"])

    def _before(self, after: DataFrame, note: Row) -> DataFrame | None:
        if not files.exists(self.spark, self.path):
            return None
        stored = self.spark.read.parquet(self.path)
        if note["replace"]:
            return stored
        # one value per partition that the stage holds
        touched = [row[0] for row in after.select(self.partition).distinct().collect()]
        return stored.filter(F.col(self.partition).isin([*touched, *note["emptied"]]))

    def _record(self, version: int, after: DataFrame, before: DataFrame | None, operation: str, moment: dt.datetime) -> None:
        target = f"{self.folder}/changes/{VERSION}={version}"
        write_parquet(differences(before, after), target)
        counts = self.spark.read.parquet(target).agg(
            F.coalesce(F.sum(F.greatest(DELTA, F.lit(0))), F.lit(0)).alias("added"),
            F.coalesce(-F.sum(F.least(DELTA, F.lit(0))), F.lit(0)).alias("removed"),
        )
        row = counts.select(F.lit(moment).cast("timestamp_ntz").alias(COMMITTED_AT), F.lit(operation).alias("operation"), "added", "removed")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/{VERSION}={version}")

    def _publish(self, note: Row) -> None:
        if note["replace"]:
            files.recover(self.spark, note["stage"], self.path)
            if files.exists(self.spark, note["stage"]):
                files.publish(self.spark, note["stage"], self.path)
            return
        overwrite_partitions(self._staged(note), self.path, [self.partition], rebalance=False)
        for value in note["emptied"]:
            files.delete(self.spark, f"{self.path}/{self.partition}={value}")
        files.delete(self.spark, note["stage"])

    # ---- maintenance --------------------------------------------------------------

    def rollback(self, version: int, moment: dt.datetime | None = None) -> int:
        """Give the table the rows of ``version`` again, as a new version.  Only partitions changed since are rewritten."""
        self.finish()
        wanted, stage = self.as_of(version), f"{self.path}__rolling_back"
        if self.partition is None:
            write_parquet(wanted, stage)
            return self.commit(stage, f"rollback to {version}", True, moment=moment)
        # one value per partition that changed
        changed = [row[0] for row in self.changes(version).select(self.partition).distinct().collect()]
        write_parquet(wanted.filter(F.col(self.partition).isin(changed)), stage, partition_by=[self.partition])
        filled = {row[0] for row in self.spark.read.schema(wanted.schema).parquet(stage).select(self.partition).distinct().collect()}
        emptied = sorted(str(value) for value in changed if value not in filled)
        return self.commit(stage, f"rollback to {version}", False, emptied, moment)

    def expire(self, older_than: dt.datetime, retain_last: int = 3) -> int:
        """Forget versions committed before ``older_than`` that are not among the ``retain_last`` newest.

        What goes is a prefix of the history.  Its rows become the base of the oldest version that stays; what was
        read as of a kept version stays the same.  Returns the new floor.
        """
        if retain_last < 1:
            raise ValueError("at least one version must be kept")
        self.finish()
        history = sorted((row[VERSION], row[COMMITTED_AT]) for row in self.commits().collect())  # a row a version
        kept = [v for v, at in history if at >= older_than] + [v for v, _ in history[-retain_last:]]
        floor = min(kept, default=0)
        if floor <= max(1, self.floor()):
            return self.floor()
        log = self._log(floor)
        columns = [name for name in log.columns if name not in (VERSION, DELTA)]
        base = log.groupBy(*columns).agg(F.sum(DELTA).alias(DELTA)).filter(F.col(DELTA) != 0)
        write_parquet(base, f"{self.folder}/base/{VERSION}={floor}")
        # from here on readers start from the new base; what it replaces can go
        self.spark.createDataFrame([(floor,)], "floor bigint").coalesce(1).write.mode("append").parquet(f"{self.folder}/floors")
        stored = self.spark.read.parquet(f"{self.folder}/commits").select(VERSION).collect()  # also what an earlier, interrupted run left
        for version in (row[0] for row in stored):
            if version <= floor:
                files.delete(self.spark, f"{self.folder}/changes/{VERSION}={version}")
            if version < floor:
                files.delete(self.spark, f"{self.folder}/commits/{VERSION}={version}")
                files.delete(self.spark, f"{self.folder}/base/{VERSION}={version}")
        return floor
