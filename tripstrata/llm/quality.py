"""A document quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import free_name
from .words import NOT_SPACE, chained, hashes, mixed, spans, text_slices

#: Labelled rows that the model is fitted on, the first by hash of their id: the one bounded sample here.
SAMPLE = 8_000
#: Score from which a document counts as good.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    bits: int = 18  # slots of the hashed weights
    order: int = 2  # longest word n-gram
    shape: bool = True  # with the shape of each word, which tells shouting and strings of marks from prose
    repeats: bool = True  # with a level of how often words are repeated at once
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0005
    epochs: int = 4


_CLASS = np.full(256, 3, np.uint8)  # letters of other alphabets, bytes of UTF-8
for _first, _last, _kind in ((0x00, 0x2F, 1), (0x30, 0x39, 2), (0x3A, 0x40, 1), (0x41, 0x5A, 4), (0x5B, 0x60, 1), (0x61, 0x7A, 3), (0x7B, 0x7F, 1)):
    _CLASS[_first : _last + 1] = _kind


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per word: kinds of its first and last two bytes and whether each kind occurs at all."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    kind = _CLASS[data]
    out = kind[starts].astype(np.uint64) + np.uint64(5) * kind[ends - 1] + np.uint64(25) * kind[np.maximum(starts, ends - 2)]
    for k in (1, 2, 3, 4):
        seen = np.concatenate(([0], np.cumsum(kind == k)))
        out = out + np.uint64(125 << k) * (seen[ends] > seen[starts]).astype(np.uint64)
    return out


#: Levels of the share of words that stand one or two places before, too.
REPEATED = (0.02, 0.06, 0.15, 0.3)


def repetition(words: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Level of each text's share of word pairs "a a" and "a b a"; ten words more count as fresh, so short texts need more."""
    hits = np.zeros(rows)
    for gap in (1, 2):
        same = (words[gap:] == words[:-gap]) & (owner[gap:] == owner[:-gap])
        hits += np.bincount(owner[gap:][same], minlength=rows)
    return np.searchsorted(REPEATED, hits / (10 + np.bincount(owner, minlength=rows)), "right")


def features(texts: pa.Array, settings: Settings) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of texts: (first row, end row, row, slot, value), sorted by row.  The value of a slot is
    1 + log of its count, and each row is scaled to length one, so long and short texts compare."""
    for row, end, data, offsets in text_slices(texts):
        starts, ends, before = spans(data, offsets, NOT_SPACE)
        owner = np.repeat(np.arange(end - row, dtype=np.uint64), np.diff(before))
        words = hashes(data, starts, ends)
        keys, rows = [], []
        for n in range(1, settings.order + 1):
            grams = chained(words, n)
            inside = owner[: len(grams)] == owner[n - 1 :][: len(grams)]
            keys.append(mixed(grams[inside] + np.uint64(n)))
            rows.append(owner[: len(grams)][inside])
        if settings.shape:
            keys.append(mixed(shapes(data, starts, ends) + np.uint64(1 << 40)))
            rows.append(owner)
        slot = np.concatenate(keys) >> np.uint64(64 - settings.bits)
        both, count = np.unique((np.concatenate(rows) << np.uint64(settings.bits)) | slot, return_counts=True)
        who, slot = (both >> np.uint64(settings.bits)).astype(np.int64), (both & np.uint64((1 << settings.bits) - 1)).astype(np.int32)
        value = 1 + np.log(count)
        norm = np.sqrt(np.bincount(who, value * value, end - row))
        value = value / norm[who]
        if settings.repeats:
            level = repetition(words, owner.astype(np.int64), end - row)
            at = np.searchsorted(who, np.arange(end - row))
            extra = (mixed(level.astype(np.uint64) + np.uint64(1 << 41)) >> np.uint64(64 - settings.bits)).astype(np.int32)
            who, slot, value = np.insert(who, at, np.arange(end - row)), np.insert(slot, at, extra), np.insert(value, at, 0.5)
        yield row, end, who, slot, value.astype(np.float32)


@dataclass
class Model:
    settings: Settings
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Sparse dot products through the logistic function; a text without words gets the bias alone."""
        out = np.empty(len(texts))
        for row, end, who, slot, value in features(texts, self.settings):
            out[row:end] = np.bincount(who, self.weights[slot] * value, end - row)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -35, 35)))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Per-coordinate FTRL-proximal with L1 and L2 over (slots, values, label) rows, in a fixed shuffled order."""
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias, without L1
    good = sum(label for _, _, label in rows)
    # the rarer label counts as much as the other up to a factor of two, which keeps the bias near the labels' rate
    weight = {1: 1.0, 0: min(2.0, max(1.0, good / max(1, len(rows) - good)))}
    lazy = np.full(size + 1, settings.l1)
    lazy[size] = 0

    def current(at: np.ndarray) -> np.ndarray:
        pull = np.sign(z[at]) * np.maximum(np.abs(z[at]) - lazy[at], 0)
        return -pull / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

    random = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in random.permutation(len(rows)):
            slots, values, label = rows[i]
            at, x = np.append(slots, size), np.append(values, 1.0)
            w = current(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = weight[label] * (p - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha
            z[at] += g - step * w
            n[at] += g * g
    w = current(np.arange(size + 1))
    return Model(settings, w[:size].astype(np.float32), float(w[size]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, settings: Settings = Settings()) -> Model:
    """Learn from at most ``sample`` labelled rows, chosen by hash of the key.  Rows with a null key, label or text
    teach nothing; a key with several labels counts once for each.  Without any rows the score is 0.5."""
    labelled = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)").distinct()
    chosen = labelled.orderBy(F.xxhash64("k"), "k", "y").limit(sample)
    joined = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null").join(F.broadcast(chosen), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, who, slot, value in features(batch.column("text"), settings):
                cuts = np.searchsorted(who, np.arange(end - row + 1)).astype(np.int32)
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_pydict(
                    {"k": part.column("k"), "y": part.column("y"), "slots": pa.ListArray.from_arrays(pa.array(cuts), pa.array(slot)), "vals": pa.ListArray.from_arrays(pa.array(cuts), pa.array(value))}
                )

    kind = docs.schema[key].dataType.simpleString()
    table = joined.mapInArrow(run, f"k {kind}, y int, slots array<int>, vals array<float>").toArrow()
    model = fit_ftrl(_in_order(table), settings)
    del table
    pa.default_memory_pool().release_unused()  # else the driver keeps the sample's memory for good
    return model


def _in_order(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(slots, values, label) of the rows of (k, y, slots, vals) by key and label, as views of the table's own memory."""
    rows = []
    for batch in table.to_batches():
        slots, values = batch.column("slots"), batch.column("vals")
        cuts, flat, weights = slots.offsets.to_numpy(), slots.values.to_numpy(), values.values.to_numpy()
        begin = values.offsets.to_numpy()
        rows += [(flat[a:b], weights[c : c + b - a], y) for a, b, c, y in zip(cuts, cuts[1:], begin, batch.column("y").to_pylist())]
    return [rows[i] for i in pc.sort_indices(table.select(["k", "y"]), [("k", "ascending"), ("y", "ascending")]).to_pylist()]


def in_fold(key: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the key's text form falls into the fold; a null key does not."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % folds == fold, F.lit(False))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 as ``name``, which must be free; null text scores as empty text does."""
    at = docs.columns.index(text)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits floats, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shipped.value.scores(batch.column(at)))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def training_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Model:
    """The model of the rows that are not held out."""
    return fit(docs, labels.filter(~in_fold(F.col(key))), key)


def quality_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, held_out, score, predicted.  Only the text enters a score."""
    scored = with_score(docs.select(key, text), training_model(docs, labels, key), text)
    return scored.select(key, in_fold(F.col(key)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the classifier does not reject, columns unchanged."""
    score = free_name(docs.columns, "_score")
    return with_score(docs, training_model(docs, labels, key), text, score).filter(F.col(score) >= THRESHOLD).select(*docs.columns)
