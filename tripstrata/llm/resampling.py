"""Importance resampling towards a target distribution, by hashed n-gram features.

A feature is a run of words joined by one space; its bucket is the CRC of its bytes modulo the number of buckets.
An Aho-Corasick automaton holds the corpus's commonest words with a space on either side.  Each word carries its
CRC and its length, so a scan of a text emits these payloads, and the CRC of a longer run is composed from the
payloads of neighbouring words without looking at their bytes again.  Words outside the dictionary get the same
payload computed from their bytes: the dictionary's bound changes how long a scan takes, never its result.

A bucket's gain is the logarithm of its smoothed share in the target over that in the corpus.  A document's score
is the mean gain of its features plus Gumbel noise from a hash of its key; the highest scores are drawn.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import free_name, with_position
from .scratch import staged
from .words import LETTERS_DIGITS, LOWER, hashes, spans, text_slices


@dataclass(frozen=True)
class Settings:
    longest: int = 1  # words of the longest feature
    buckets: int = 10_000
    least_words: int = 20  # of a document that can be drawn
    percent: int = 10  # of those documents
    seed: int = 2024
    dictionary_words: int = 1 << 16  # the commonest ones
    dictionary_word_bytes: int = 64


#: CRC-32 with the polynomial of zlib and gzip, reflected.
POLYNOMIAL = 0xEDB88320


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """(power, byte of the CRC, its value) -> the CRC after 2**power zero bytes, which is linear in the CRC."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    after = bits
    for _ in range(8):
        after = np.where(after & 1, (after >> 1) ^ np.uint32(POLYNOMIAL), after >> 1)
    out, values = np.zeros((32, 4, 256), np.uint32), np.arange(256)
    for power in range(32):
        for byte in range(4):
            for bit in range(8):
                out[power, byte] ^= np.where(values >> bit & 1, after[8 * byte + bit], 0).astype(np.uint32)
        after = _apply(out[power], after)  # twice as many zero bytes
    return out


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """CRC of two strings one after the other, from the CRC of each and the length of the second."""
    out, power = left.astype(np.uint32), 0
    while (right_length >> power).any():
        out = np.where(right_length >> power & 1, _apply(_shifts()[power], out), out)
        power += 1
    return out ^ right


def feature_crcs(crc: np.ndarray, length: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, CRCs of all runs of k words) for k up to ``longest``, from the words' payloads in order."""
    run, space = crc, np.full(1, zlib.crc32(b" "), np.uint32)
    for k in range(1, longest + 1):
        if k > 1:
            spaced = joined_crc(run[:-1], space, np.ones(1, np.int64))
            run = joined_crc(spaced, crc[k - 1 :], length[k - 1 :])
        yield k, run
        if len(run) < 2:
            break


class Dictionary:
    """The automaton over words between spaces, and the payload of each."""

    def __init__(self, words: Sequence[bytes]):
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, word in enumerate(words):
            self.automaton.add_word(f" {word.decode('latin-1')} ", k)  # a character a byte
        if words:
            self.automaton.make_automaton()
        self.empty = not words

    def payloads(self, line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of each word of ``line``, whose words stand between spaces."""
        crc, length, known = np.zeros(len(starts), np.uint32), ends - starts, np.zeros(len(starts), bool)
        data = line.tobytes()
        if not self.empty:
            emitted = np.fromiter(chain.from_iterable(self.automaton.iter(data.decode("latin-1"))), np.int64)
            at = np.searchsorted(ends, emitted[::2])  # a match ends on the space behind its word
            crc[at], length[at], known[at] = self.crc[emitted[1::2]], self.length[emitted[1::2]], True
        unknown = np.flatnonzero(~known)
        crc[unknown] = [zlib.crc32(data[a:b]) for a, b in zip(starts[unknown].tolist(), ends[unknown].tolist())]
        return crc, length


def lines(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, line, starts, ends, words before each row) of slices: lower case, a space for every
    other byte, and one more space around each text."""
    for row, end, data, offsets in text_slices(texts):
        line = LOWER[data]
        line = np.insert(np.where(LETTERS_DIGITS[line], line, np.uint8(0x20)), offsets, np.uint8(0x20))
        starts, ends, before = spans(line, offsets + np.arange(len(offsets)), LETTERS_DIGITS)
        yield row, end, line, starts, ends, before


def common_words(texts: DataFrame, settings: Settings) -> list[bytes]:
    """The commonest words of a column ``text``, at most ``dictionary_words``; this is all that the driver sees.

    Each task hands on its own commonest ones: a word that is missed costs time in the scan, nothing else.
    """
    top, limit = settings.dictionary_words, settings.dictionary_word_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for _, _, line, starts, ends, _ in lines(batch.column(0)):
                short = ends - starts <= limit
                starts, ends, data = starts[short], ends[short], line.tobytes()
                _, first, n = np.unique(hashes(line, starts, ends), return_index=True, return_counts=True)
                for a, b, count in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                    total[data[a:b]] += count
                if len(total) > 8 * top:
                    total = Counter(dict(total.most_common(4 * top)))
        best = total.most_common(top)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], names=["word", "n"])

    counted = texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in counted.orderBy(F.desc("n"), "word").limit(top).collect()]


_built: dict[str, Dictionary] = {}


def _dictionary(name: str, words: Broadcast) -> Dictionary:
    """One automaton a worker, kept from task to task."""
    if name not in _built:
        _built.clear()
        _built[name] = Dictionary(words.value)
    return _built[name]


def features(rows: DataFrame, words: Broadcast, settings: Settings) -> DataFrame:
    """(key, text) -> (key, n_words, n_features, buckets): the bucket of each feature, four bytes each."""
    name, longest, modulus = uuid.uuid4().hex, settings.longest, settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _dictionary(name, words)
        for batch in batches:
            for row, end, line, starts, ends, before in lines(batch.column("text")):
                crc, length = dictionary.payloads(line, starts, ends)
                owner = np.repeat(np.arange(end - row), np.diff(before))
                owners, buckets = [], []
                for k, runs in feature_crcs(crc, length, longest):
                    inside = owner[: len(runs)] == owner[k - 1 :]
                    owners.append(owner[: len(runs)][inside])
                    buckets.append((runs[inside] % np.uint32(modulus)).astype("<u4"))
                whose, found = np.concatenate(owners), np.concatenate(buckets)
                if longest > 1:
                    found = found[np.argsort(whose, kind="stable")]
                n = np.bincount(whose, minlength=end - row)
                cuts = np.concatenate(([0], np.cumsum(n))) * 4
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch.column("key").slice(row, end - row),
                        "n_words": pa.array(np.diff(before), pa.int64()),
                        "n_features": pa.array(n, pa.int64()),
                        "buckets": pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - row, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(found.tobytes())]).cast(pa.binary()),
                    }
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, settings: Settings) -> np.ndarray:
    """Features in each bucket, summed in tasks and then by Spark; a row a bucket reaches the driver."""
    modulus = settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(modulus, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u4"), minlength=modulus)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    out = np.zeros(modulus, np.int64)
    for r in found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the corpus), for each bucket."""
    size = len(corpus)
    over, under = int(corpus.sum()) + size, int(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * over / ((s + 1.0) * under))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean gain of a document's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(v.as_buffer(), "<u4")].sum()) for v in batch.column("buckets")]
            weight = [s // n if n else 0 for s, n in zip(sums, batch.column("n_features").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "n_words", "n_features")] + [pa.array(weight, pa.int64())], names=["key", "n_words", "n_features", "weight"])

    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


def resample_report(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: key, n_features, weight, score, and rank (1, 2, 3 ... for drawn rows, else null).

    The text passes the dictionary's count and one scan; what follows reads buckets, four bytes a feature.  Null or
    empty text has no features, weight 0, and is never drawn.  A null key counts as empty in the hash and comes last
    among equal scores.  Repeated rows are rows of their own.  An empty target has share 0 everywhere; an empty
    table gives none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    goal = target.select(F.lit(0).alias("key"), F.col(target_text).alias("text"))
    words = spark.sparkContext.broadcast(common_words(rows.select("text").union(goal.select("text")), settings))
    found = staged(features(rows, words, settings), "features")
    gain = gains(bucket_counts(found, settings), bucket_counts(features(goal, words, settings), settings))
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(share)))
    scored = staged(weighed(found, gain).withColumn("score", (F.col("weight") + noise).cast("long")), "scores")
    able = F.col("n_words") >= settings.least_words
    draws = scored.filter(able).count() * settings.percent // 100
    placed = with_position(scored.filter(able), [F.desc("score"), F.col("key").asc_nulls_last(), F.desc("weight"), F.desc("n_features")], "place")
    rank = F.when(F.col("place") < draws, F.col("place") + 1)
    out = placed.withColumn("rank", rank).drop("place").union(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn documents, columns unchanged.  Rows that share a key with a drawn one come along."""
    drawn = free_name(docs.columns, "_drawn")
    keys = resample_report(docs, target, key, text, **options).filter("rank is not null").select(F.col(key).alias(drawn)).distinct()
    return docs.join(keys, F.col(key).eqNullSafe(F.col(drawn)), "left_semi")
