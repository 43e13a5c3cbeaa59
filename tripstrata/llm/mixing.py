"""Mixing sources to target weights by hash thresholds.

A document's place in its source is a hash of its id, so a source's share of any size is a prefix of the hash
range, and a smaller budget takes a subset of a larger one's documents.  The threshold comes from histograms:
sizes are summed by source and hash bucket, running totals find the bucket in which the budget ends, and only
that bucket is summed again by the next bits.  Nothing is sorted; a last filter compares hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import staged

HASH_BITS = 60
#: Bits by which a histogram level splits a bucket: at most 4096 rows a source go on to the running totals.
LEVEL_BITS = 12
#: Above this many sources the plan, one row a source, is joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 50_000

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def place(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text form; a null key counts as empty."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


@dataclass(frozen=True)
class SourcePlan:
    """Every document of the source is taken ``copies`` times, and once more up to hash ``threshold``."""

    source: str | None
    size: int
    target: float
    copies: int
    threshold: int


def targets(sizes: dict, weights: Sequence[int], share: Fraction, limit: int) -> dict:
    """Target by source: ``share`` of all sizes by weight (repeating, in code point order, null last); none above
    ``limit`` times its source, what it would exceed going to the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        each = share * total - limit * sum(sizes[s] for s in capped)
        over = {s for s in rest if weight[s] * each > limit * sizes[s] * sum(weight[r] for r in rest)}
        if not over:
            break
        capped |= over
    whole = sum(weight[r] for r in rest)
    out = {s: float(limit * sizes[s]) for s in capped}
    for s in rest:
        part = Fraction(weight[s]) * each
        out[s] = part.numerator / (part.denominator * whole)
    return out


def sized(docs: DataFrame, key: str, source: str, size: Column) -> DataFrame:
    """What thresholds need of each document: (key, source, place, size), staged, so that texts are read once."""
    return staged(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), place(F.col(key)).alias("place"), size.alias("size")), "mix-sizes")


def plan_mix(rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), limit: int = 2) -> list[SourcePlan]:
    """One plan a source; the driver sees a row a source and level, never documents.

    The documents of a source stand in hash order; one is taken while twice the size before it plus its own is at
    most twice what is wanted, so the total ends as near the target as whole documents in this order allow.
    Documents with the same key stand together and are taken or left together.
    """
    spark = rows.sparkSession
    sizes = {r["source"]: r["size"] for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    goal = targets(sizes, weights, share, limit)
    copies = {s: int(goal[s] // n) if n else 0 for s, n in sizes.items()}
    wanted = {s: goal[s] - copies[s] * n for s, n in sizes.items()}
    threshold = {s: -1 for s in sizes}
    open_ = {s: (0, 0) for s, n in sizes.items() if n and wanted[s] > 0}  # bucket of the level above, size before it
    for used in range(LEVEL_BITS, HASH_BITS + 1, LEVEL_BITS):
        if not open_:
            break
        at = spark.createDataFrame([(s, bucket, before, wanted[s]) for s, (bucket, before) in open_.items()], "source string, above long, before long, wanted double")
        at = F.broadcast(at) if len(open_) <= BROADCAST_SOURCES else at
        bucket = F.shiftright("place", HASH_BITS - used)
        inside = rows.withColumn("bucket", bucket).alias("d").join(
            at.alias("a"), F.col("d.source").eqNullSafe(F.col("a.source")) & (F.shiftright("d.bucket", LEVEL_BITS) == F.col("a.above"))
        )
        bars = inside.groupBy(F.col("d.source").alias("source"), "bucket").agg(
            F.sum("size").alias("size"), F.min("place").alias("low"), F.max("place").alias("high"), F.first("before").alias("before"), F.first("wanted").alias("wanted")
        )
        so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        bars = bars.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        ends = bars.filter((F.col("before") <= F.col("wanted")) & (F.col("wanted") < F.col("before") + F.col("size"))).collect()
        open_ = {}
        for r in ends:
            if r["low"] == r["high"]:
                threshold[r["source"]] = r["low"] - (2 * r["before"] + r["size"] > 2 * wanted[r["source"]])
            else:
                open_[r["source"]] = (r["bucket"], r["before"])
    return [SourcePlan(s, n, goal[s], copies[s], threshold[s]) for s, n in sizes.items()]


def with_plan(docs: DataFrame, plan: list[SourcePlan], source: Column, at: Column) -> DataFrame:
    """``docs`` with ``_copies``, and the plan's ``_source_size`` and ``_target``."""
    table = docs.sparkSession.createDataFrame(
        [(p.source, p.size, p.target, p.copies, p.threshold) for p in plan], "_source string, _source_size long, _target double, _base long, _threshold long"
    )
    table = F.broadcast(table) if len(plan) <= BROADCAST_SOURCES else table
    joined = docs.join(table, source.eqNullSafe(F.col("_source")), "left")
    return joined.withColumn("_copies", F.col("_base") + (at <= F.col("_threshold")).cast("long")).drop("_source", "_base", "_threshold")


def mixture(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, every row as often as its source's target asks (0 to ``limit`` times).

    Sizes are words.  Null text has size 0 and is kept or repeated like any other row of its source; rows with a
    null source form a source of their own; equal keys go together; an empty table gives an empty mix.
    """
    plan = plan_mix(sized(docs, key, source, word_count(F.col(text))), **options)
    rows = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"))  # so no name of theirs can clash
    repeated = with_plan(rows, plan, F.col("row")[source], place(F.col("row")[key])).filter("_copies > 0")
    return repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")


def mix_report(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """Per document (key, size, source_size, target, taken): ``taken`` is its words times its copies in the mix."""
    rows = sized(docs, key, source, word_count(F.col(text)))
    plan = plan_mix(rows, **options)
    return with_plan(rows, plan, F.col("source"), F.col("place")).select(
        F.col("key").alias(key), "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("size") * F.col("_copies")).alias("taken")
    )
