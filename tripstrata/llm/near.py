"""MinHash near-duplicate detection with tensored banding and exact verification.

A document has 12 collections of three minhashes.  Every pair of collections makes one table key, so 66 tables
of six rows each cost 36 minhashes instead of 396.  At the similarity limit of 0.8 a collection agrees with
probability 0.51, and two of twelve do so with 0.997.

Documents with equal shingle sets stand behind one representative.  Those that share a table key, directly or
through others, form a candidate group; its texts are brought together once and links are confirmed on full
shingle sets.  Groups of up to ``BLOCK`` documents are compared all against all in one task.  Larger ones are cut
into blocks and compared with blocks of hub documents, those nearest the group's consensus first, round after round, until
every document outside the group's largest component has been a hub: every pair that could still join two
components has then been compared, at a cost that follows the documents left over, not the square of the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import Forest, components
from .scratch import staged
from .words import LOWER, NOT_SPACE, chained, hashes, spans, text_slices


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: tuple[int, int] = (80, 100)  # intersection / union, as a fraction
    collections: int = 12
    rows: int = 3
    block: int = 256  # documents of a candidate group that one task compares at a time, with as many hubs
    block_shingles: int = 2_000_000  # of these documents, about; a longer text is alone
    hubs: int = 256  # of the first round, about; each round doubles them


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of ``width``-word shingles of each text; of the whole sequence if it is shorter."""
    for _, _, data, offsets in text_slices(texts):
        data = LOWER[data]
        starts, ends, before = spans(data, offsets, NOT_SPACE)
        words = hashes(data, starts, ends)
        grams = chained(words, width)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            yield np.unique(grams[a : b - width + 1]) if b - a >= width else chained(words[a:b], max(1, b - a))


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(80)
    return random.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, count, dtype=np.uint64)


def sketches(docs: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(key, n, name, bands): size and 128-bit name of each shingle set, and one value a collection of minhashes."""
    count = settings.collections * settings.rows
    times, plus = _multipliers(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, bands = [], [], []
            for found in shingle_sets(batch.column("text"), settings.shingle):
                sizes.append(len(found))
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                if len(found):
                    low = np.array([(found * a + b).min() for a, b in zip(times, plus)]).reshape(settings.collections, settings.rows)
                    bands.append(chained_rows(low).view(np.int64))
                else:
                    bands.append(None)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "n": pa.array(sizes, pa.int64()), "name": pa.array(names, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n long, name binary, bands array<long>")


def chained_rows(low: np.ndarray) -> np.ndarray:
    out = low[:, 0]
    for k in range(1, low.shape[1]):
        out = chained(np.stack((out, low[:, k]), 1).ravel(), 2)[::2]
    return out


class Links:
    """Links between documents of a block and hubs, on full sets."""

    def __init__(self, sets: list[np.ndarray], settings: Settings):
        self.sizes = np.array([len(s) for s in sets])
        self.flat = np.concatenate(sets)
        self.values, self.ids = np.unique(self.flat, return_inverse=True)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.mark = np.zeros(len(self.values), np.int32)
        self.top, self.bottom = settings.similarity

    def of(self, hub: np.ndarray) -> np.ndarray:
        """Indexes of the documents linked with the set ``hub``."""
        at = np.searchsorted(self.values, hub)
        at = at[at < len(self.values)]
        at = at[np.isin(self.values[at], hub, assume_unique=True)]
        self.mark[at] = 1
        shared = np.add.reduceat(self.mark[self.ids], self.first)
        self.mark[at] = 0
        return np.flatnonzero(self.bottom * shared >= self.top * (len(hub) + self.sizes - shared))


def _solved(rows: list[tuple[object, str, bool]], settings: Settings) -> Forest:
    """``rows`` of a block: (key, text, is a hub from elsewhere).  Without hubs all are compared with all."""
    sets = list(shingle_sets(pa.array([t for _, t, _ in rows], pa.large_string()), settings.shingle))
    own = [i for i, r in enumerate(rows) if not r[2] and len(sets[i])]  # a key can have another row, without words
    hubs = [i for i, r in enumerate(rows) if r[2] and len(sets[i])] if any(r[2] for r in rows) else own
    if not own:
        return Forest()
    links, forest = Links([sets[i] for i in own], settings), Forest()
    for i in own:
        forest.root(rows[i][0])
    for i in hubs:
        for j in links.of(sets[i]):
            forest.join(rows[i][0], rows[own[j]][0])
    return forest


def _blocks_solved(frame: DataFrame, settings: Settings, kind: str) -> DataFrame:
    """(grp, salt, part, hub, key, text) -> (a, b): a forest of the links in each block of (grp, salt, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows):
            pairs = [(x, r) for x, r in _solved(rows, settings).above.items() if x != r]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], out_type) for k in (0, 1)], names=["a", "b"])

        at, rows, out_type = None, [], None
        for batch in batches:
            out_type = batch.schema.field("key").type
            for *block, hub, key, text in zip(*(batch.column(c).to_pylist() for c in ("grp", "salt", "part", "hub", "key", "text"))):
                if at != block and any(not r[2] for r in rows):
                    yield solved(rows)
                if at != block:
                    at, rows = block, []
                rows.append((key, text, hub))
        if any(not r[2] for r in rows):
            yield solved(rows)

    return frame.repartition("grp", "salt", "part").sortWithinPartitions("grp", "salt", "part").mapInArrow(run, f"a {kind}, b {kind}")


def _hubs(waiting: DataFrame, count: int) -> DataFrame:
    """About ``count`` rows of each group, those that agree most first: (grp, key, blocks, size).

    Rows are taken by their agreement and a bucket of their key of about a block's size, so that windows see counts of
    buckets and no group's rows are ranked in one task.
    """
    bucket = F.pmod(F.xxhash64("key", F.lit("hub")), F.col("blocks")).cast("int")
    dealt = waiting.withColumn("bucket", bucket)
    so_far = Window.partitionBy("grp").orderBy(F.desc("agree"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    bars = dealt.groupBy("grp", "agree", "bucket").count().withColumn("before", F.coalesce(F.sum("count").over(so_far), F.lit(0)))
    best = bars.filter(F.col("before") < count).select("grp", "agree", "bucket")
    return staged(dealt.join(best, ["grp", "agree", "bucket"]).select("grp", "key", "blocks", "size"), "hubs")


def _blocks(settings: Settings) -> Column:
    """Aggregate: blocks that rows with ``size`` shingles are dealt to, bounded by documents and by shingles."""
    return F.greatest(F.ceil(F.count("*") / settings.block), F.ceil(F.sum("size") / settings.block_shingles)).cast("int")


def _large_groups(texts: DataFrame, settings: Settings, kind: str) -> DataFrame:
    """Links of the groups over the block size, as (a, b): hub rounds, see the module's text."""
    bands = texts.select("grp", "key", F.posexplode("bands").alias("band", "value"))
    votes = bands.groupBy("grp", "band", "value").count().groupBy("grp", "band").agg(F.max_by("value", F.struct("count", "value")).alias("value"))
    agree = bands.join(votes, ["grp", "band", "value"]).groupBy("grp", "key").agg(F.count("*").alias("agree"))
    ranked = staged(texts.select("grp", "key", "blocks", "size").join(agree, ["grp", "key"], "left").select("grp", "key", "blocks", "size", F.coalesce("agree", F.lit(0)).alias("agree")), "agree")
    waiting, hubs, found, asked = ranked, settings.hubs, None, None
    while True:
        chosen = _hubs(waiting, hubs)
        asked = chosen if asked is None else asked.union(chosen)
        parts = chosen.groupBy("grp").agg(_blocks(settings).alias("parts"))
        dealt = chosen.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.col("parts")).cast("int"))
        copies = dealt.join(texts.select("grp", "key", "text"), ["grp", "key"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        own = texts.join(parts, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        rows = own.select("grp", "salt", "part", F.lit(False).alias("hub"), "key", "text").union(copies.select("grp", "salt", "part", F.lit(True), "key", "text"))
        links = _blocks_solved(rows, settings, kind)
        found = staged(links if found is None else links.union(found), "links")
        labels = components(found)
        label = ranked.join(labels, ranked["key"] == labels["node"], "left").select("grp", "key", "blocks", "size", "agree", F.coalesce("label", "key").alias("label"))
        sizes = label.groupBy("grp", "label").count()
        largest = sizes.groupBy("grp").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
        waiting = staged(label.join(largest, "grp").filter("label <> largest").select("grp", "key", "blocks", "size", "agree").join(asked.select("grp", "key"), ["grp", "key"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return found
        hubs *= 2


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links), kept (key = component_id).

    A text without words, or null, has no shingles and links with nothing.  Rows with a null key link with nothing
    and are kept, with a null component.  Rows that share a key are one document.  An empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = staged(sketches(docs, key, text, settings), "sketches")
    full = rows.filter("n > 0 and key is not null")
    sets = full.groupBy("name").agg(F.min("key").alias("key"), F.first("bands").alias("bands"), F.first("n").alias("size"))
    tables = [F.xxhash64(F.lit(t), F.col("bands")[i], F.col("bands")[j]) for t, (i, j) in enumerate(combinations(range(settings.collections), 2))]
    slots = sets.select("key", F.explode(F.array(*tables)).alias("slot"))
    shared = slots.groupBy("slot").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("slot", "hub")
    group = components(slots.join(shared, "slot").filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct())
    group = group.join(sets.select("key", "size"), F.col("node") == F.col("key")).select("label", "node", "size")
    blocks = group.groupBy("label").agg(_blocks(settings).alias("blocks"))
    members = group.join(blocks, "label").select(F.col("label").alias("grp"), F.col("node").alias("key"), "size", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("salt"))
    banded = members.join(full.groupBy("key").agg(F.first("bands").alias("bands")), "key")
    texts = staged(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(banded, "key"), "near-texts")
    small = texts.filter("blocks = 1").select("grp", "salt", F.lit(0).alias("part"), F.lit(False).alias("hub"), "key", "text")
    links = staged(_blocks_solved(small, settings, kind), "links")
    large = texts.filter("blocks > 1")
    if not large.isEmpty():
        links = links.union(_large_groups(large, settings, kind))
    label = components(links)
    # staged, so that both sides of the join on the set's name are shuffled and Spark can split a set with many copies
    of_set = staged(sets.select("name", "key").join(label, F.col("key") == F.col("node"), "left").select("name", F.coalesce("label", "key").alias("component_id")), "sets")
    alone = rows.filter("n = 0 or key is null").select("key", "n", F.col("key").alias("component_id"))
    linked = full.join(of_set, "name").select("key", "n", "component_id").union(alone)
    return linked.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One document of each component, columns unchanged."""
    gone = near_duplicates(docs, key, text, settings).filter("not kept").select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
