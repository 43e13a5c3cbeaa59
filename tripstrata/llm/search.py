"""Ranked lexical search over impact-sorted posting lists, by reads in sequence only (no random access).

A document's score for an item is the sum of the impacts of the item's terms; an impact is a whole number from a
term's rarity, its count in the document and the document's length.  Documents are searched where they are stored:
a task takes its documents a shard at a time and sorts each term's postings by impact.  For each item it reads the
lists in parallel, best impacts first.  What was read of a document is the lower end of its score interval; adding
the next unread impact of each list in which it was not met gives the upper end.  Reading goes on until no other
document can reach the best ones, equal scores included, and every score that is left is known exactly.  A list is
read no further once no open document can be in its rest.  Shards start from the best scores of those before, and
what leaves a task is its best documents of each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import staged
from .words import LETTERS_DIGITS, LOWER, hashes, spans, text_slices

TOP = 50
#: Distinct terms of the items that are searched for together; a longer item is alone.
BLOCK_TERMS = 200_000
#: Postings of a shard, about.
SHARD_POSTINGS = 1 << 21
#: Postings that the first reads of each list take; later ones take twice as many as those before.
FIRST_READ = 64

# Fixed values of the score: its scale, the weight of length in percent, and the damping of counts.
SCALE, LENGTH_PERCENT, DAMPING = 1_000_000_000, 50, 20


def terms_of(text: Column) -> Column:
    """All terms of a text, repeats too; null has none."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1)), F.array())


@dataclass(frozen=True)
class Vocabulary:
    """Terms of a block of items by the order of their hashes; a term's number is its place."""

    hashes: np.ndarray

    @staticmethod
    def of(terms: list[str]) -> tuple[Vocabulary, dict[str, int]]:
        data = [t.encode("utf-8", "surrogatepass") for t in terms]
        ends = np.cumsum([len(d) for d in data], dtype=np.int64)
        starts = ends - [len(d) for d in data] if data else ends
        names = hashes(np.frombuffer(b"".join(data), np.uint8), starts, ends)
        order = np.argsort(names)
        return Vocabulary(names[order]), {terms[k]: place for place, k in enumerate(order.tolist())}

    def numbers(self, names: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those that are no term."""
        if not len(self.hashes):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.hashes, names), len(self.hashes) - 1)
        return np.where(self.hashes[at] == names, at, -1)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Stretches of four-byte numbers as one binary value each."""
    data = pa.py_buffer(values.astype("<i4").tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 4).astype(np.int64)), data]).cast(pa.binary())


def counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(key, text) -> (key, n, terms, counts): a document's number of terms, and which of the vocabulary it holds how
    often, four bytes each.  Documents without any term are left out."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        width = max(1, len(known.hashes))
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                data = LOWER[data]
                starts, ends, before = spans(data, offsets, LETTERS_DIGITS)
                number = known.numbers(hashes(data, starts, ends))
                owner = np.repeat(np.arange(end - row), np.diff(before))
                pairs, times = np.unique(owner[number >= 0] * width + number[number >= 0], return_counts=True)
                cuts = np.searchsorted(pairs, np.arange(end - row + 1) * width)
                n = np.diff(before)
                out = pa.RecordBatch.from_pydict(
                    {"key": batch.column("key").slice(row, end - row), "n": pa.array(n, pa.int64()), "terms": _binary(pairs % width, cuts), "counts": _binary(times, cuts)}
                )
                yield out.filter(pa.array(n > 0))

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n long, terms binary, counts binary")


def document_frequencies(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; summed in tasks, then by Spark, and a row a term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total[np.frombuffer(value.as_buffer(), "<i4")] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int64()), "df": pa.array(total[seen], pa.int64())})

    out = np.zeros(size, np.int64)
    for r in index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


@dataclass(frozen=True)
class Scoring:
    """What impacts depend on beside the document: sums over the corpus and the weight of each term."""

    documents: int
    terms: int
    weight: np.ndarray

    @staticmethod
    def of(documents: int, terms: int, df: np.ndarray) -> Scoring:
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()]
        return Scoring(documents, terms, np.array(weight, np.int64))

    def impacts(self, term: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of postings; ``length`` is the number of terms of each posting's document."""
        long = 100 - LENGTH_PERCENT + LENGTH_PERCENT * length * self.documents // self.terms
        return self.weight[term] * (SCALE * count // (1000 * count + DAMPING * long))


class Shard:
    """Impact-sorted posting lists of some documents."""

    def __init__(self, length: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, scoring: Scoring):
        impact = scoring.impacts(term, count, length[doc])
        order = np.lexsort((-impact, term))
        self.docs, self.impact, self.size = doc[order], impact[order], len(length)
        self.cuts = np.searchsorted(term[order], np.arange(len(scoring.weight) + 1))

    def search(self, terms: np.ndarray, top: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the ``top`` with a score above 0, and their exact scores.

        ``known`` are scores of documents elsewhere.  Documents with the last score that counts are all returned.
        """
        lists = [(self.docs[a:b], self.impact[a:b]) for a, b in zip(self.cuts[terms].tolist(), self.cuts[terms + 1].tolist()) if a < b and self.impact[a] > 0]
        lower, met = np.zeros(self.size, np.int64), np.zeros((len(lists), self.size), bool)
        open_, is_open = np.zeros(0, np.int64), np.zeros(self.size, bool)
        place, step, admits = [0] * len(lists), FIRST_READ, True
        ahead = np.array([impact[0] for _, impact in lists], np.int64)  # the next unread impact of each list
        needed = range(len(lists))
        while len(needed):
            for t in needed:
                docs, impact = lists[t]
                a, b = place[t], min(place[t] + step, len(docs))
                read, value = docs[a:b], impact[a:b]
                if not admits:
                    ours = is_open[read]
                    read, value = read[ours], value[ours]
                lower[read] += value
                met[t, read] = True
                place[t], ahead[t] = b, impact[b] if b < len(docs) else 0
            step *= 2
            if admits:
                open_ = np.flatnonzero(lower)
            least = np.concatenate((lower[open_], known))
            limit = max(1, int(np.partition(least, -top)[-top])) if len(least) >= top else 1
            upper = lower[open_] + ahead @ ~met[:, open_]
            open_ = open_[upper >= limit]
            admits = admits and int(ahead.sum()) >= limit  # a document not met yet can still count
            if not admits:
                is_open[:] = False
                is_open[open_] = True
            missing = ~met[:, open_].all(axis=1)
            needed = [t for t in range(len(lists)) if ahead[t] > 0 and (admits or missing[t])]
        return open_, lower[open_]


def _best(index: DataFrame, items: list[np.ndarray], scoring: Scoring, top: int, shard_postings: int) -> DataFrame:
    """(number, key, score): the best documents of each item in each task."""
    context = index.sparkSession.sparkContext
    shipped = context.broadcast((items, scoring))  # a block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, scoring = shipped.value
        best: list[list[tuple]] = [[] for _ in items]
        lengths, terms, counts, keys, kind = [], [], [], [], None

        def searched() -> None:
            sizes = [len(t) for t in terms]
            shard = Shard(np.concatenate(lengths), np.repeat(np.arange(len(sizes)), sizes), np.concatenate(terms), np.concatenate(counts), scoring)
            for k, wanted in enumerate(items):
                found, scores = shard.search(wanted, top, np.array([-b[0] for b in best[k]], np.int64))
                more = [(-s, keys[d] is None, 0 if keys[d] is None else keys[d], keys[d]) for d, s in zip(found.tolist(), scores.tolist())]
                best[k] = sorted(best[k] + more, key=lambda b: b[:3])[:top]

        for batch in batches:
            kind = batch.schema.field("key").type
            lengths.append(batch.column("n").to_numpy())
            keys.extend(batch.column("key").to_pylist())
            for name, into in (("terms", terms), ("counts", counts)):
                into.extend(np.frombuffer(v.as_buffer(), "<i4").astype(np.int64) for v in batch.column(name))
            if sum(map(len, terms)) >= shard_postings:
                searched()
                lengths, terms, counts, keys = [], [], [], []
        if keys:
            searched()
        rows = [(k, b[3], -b[0]) for k, found in enumerate(best) for b in found]
        if rows:
            number, key, score = zip(*rows)
            yield pa.RecordBatch.from_pydict({"number": pa.array(number, pa.int32()), "key": pa.array(key, kind), "score": pa.array(score, pa.int64())})

    kind = index.schema["key"].dataType.simpleString()
    return index.mapInArrow(run, f"number int, key {kind}, score long")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    top: int = TOP, block_terms: int = BLOCK_TERMS, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """Per item its ``top`` documents with a score above 0: item, rank (from 1), key, score.

    Equal scores by ascending key, null last.  Rows of ``items`` that share an id, null too, are one item with the
    terms of all; an item without terms has no rows, nor has an empty table.  Rows of ``docs`` that share a key are
    documents of their own; null text has no terms.  Items are searched in blocks of ``block_terms`` distinct terms,
    and the driver holds one block at a time: each block counts its terms in the whole texts once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    pairs = items.select(F.col(item).alias("item"), F.explode(F.array_distinct(terms_of(F.col(item_text)))).alias("term"))
    asked = staged(pairs.groupBy("item").agg(F.collect_set("term").alias("terms")), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    item_kind = asked.schema["item"].dataType.simpleString()
    out = None
    for block in range(blocks):
        # one block of items; their terms are the bound
        group = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item").collect()
        vocabulary, number = Vocabulary.of(sorted({t for r in group for t in r["terms"]}))
        wanted = [np.array(sorted(number[t] for t in r["terms"]), np.int64) for r in group]
        index = staged(counted(rows, vocabulary), "postings")
        size = index.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        scoring = Scoring.of(size["documents"], max(1, size["terms"]), document_frequencies(index, len(number)))
        best = _best(index, wanted, scoring, top, shard_postings)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(group)], f"number int, item {item_kind}")
        found = ranked.join(names, "number").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
        found = staged(found, "found") if blocks > 1 else found
        out = found if out is None else out.union(found)
    return out
