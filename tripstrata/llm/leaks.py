"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and test items are normalised to lower-case words with one space between and around them.  The automaton
holds every window of ten item words (a shorter item is one window), and each text passes through it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.ranking import free_name
from .words import LETTERS_DIGITS, LOWER

WINDOW = 10
#: Words of test items in one automaton (about 60 bytes a normalised character while it is built).  A larger
#: benchmark is cut into several automata, which the texts pass one after another in the same stage.
AUTOMATON_WORDS = 200_000

_TO_WORDS = bytes(int(LOWER[b]) if LETTERS_DIGITS[LOWER[b]] else 0x20 for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


def windows(words: Sequence[bytes], width: int = WINDOW) -> list[bytes]:
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + width]) + b" " for i in range(max(1, len(words) - width + 1))]


class Matcher:
    """Which windows of which items occur in a text, and which words of it they cover."""

    def __init__(self, items: Iterable[tuple[str, str | None]], width: int = WINDOW):
        found: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            words = normal_words(text)
            for w in windows(words, width):
                found.setdefault(w.decode("utf-8"), (min(width, len(words)), set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, (n, names) in found.items():
            self.automaton.add_word(pattern, (len(pattern), n, tuple(names)))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, np.ndarray | None, set[str]]:
        """(number of words, hit flag of each or None, items)."""
        words = normal_words(text)
        if self.empty or not words:
            return len(words), None, set()
        line = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(line.decode("utf-8")))
        if not found:
            return len(words), None, set()
        lengths = np.fromiter((len(w.decode("utf-8")) for w in words), np.int64, len(words))
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))  # of the space before each word
        change, items = np.zeros(len(words) + 1, np.int64), set()
        for end, (length, n, names) in found:
            first = np.searchsorted(starts, end - length + 1)
            change[first] += 1
            change[first + n] -= 1
            items.update(names)
        return len(words), np.cumsum(change[:-1]) > 0, items

    def spans(self, text: str | None, hit: np.ndarray | None) -> list[tuple[int, int]]:
        """Byte spans of the original text from the first to the last word of each run of hit words."""
        if hit is None:
            return []
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TO_WORDS), np.uint8) != 0x20
        edges = np.flatnonzero(np.diff(np.concatenate(([0], data.view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        runs = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(runs[::2], runs[1::2])]


def item_groups(benchmark: DataFrame, item: str = "item_id", text: str = "text", limit: int = AUTOMATON_WORDS) -> list[list[tuple[str, str | None]]]:
    """The items in groups of at most ``limit`` words, a longer item alone.  Test sets are small; they
    pass through the driver item by item.  Items without id or words have no windows to report."""
    groups, words = [[]], 0
    for row in benchmark.select(F.col(item).cast("string"), text).filter(F.col(item).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        n = len(normal_words(row[1]))
        if groups[-1] and words + n > limit:
            groups.append([])
            words = 0
        groups[-1].append((row[0], row[1]))
        words += n
    return groups


#: What a scan adds to each row, under names that are free in the table.
ADDED = {
    "n_words": T.LongType(),
    "n_hit": T.LongType(),
    "hits": T.BinaryType(),
    "spans": T.ArrayType(T.LongType()),
    "items": T.ArrayType(T.StringType()),
}


def added_names(columns: Iterable[str]) -> dict[str, str]:
    """The names of :data:`ADDED` beside ``columns``: an underscore in front, and behind as many as it takes."""
    return {name: free_name(columns, f"_{name}") for name in ADDED}


def _scanned(texts: pa.Array, matcher: Matcher, before: list[dict]) -> list[dict]:
    """One matcher's findings in each text, added to those of earlier matchers."""
    out = []
    for value, old in zip(texts.to_pylist(), before):
        n, hit, names = matcher.scan(value)
        runs = [x for pair in matcher.spans(value, hit) for x in pair]
        if old["hits"] is not None:
            earlier = np.unpackbits(np.frombuffer(old["hits"], np.uint8), count=n).astype(bool)
            hit = earlier if hit is None else hit | earlier
        bits = None if hit is None else np.packbits(hit).tobytes()
        out.append({"n_words": n, "n_hit": 0 if hit is None else int(hit.sum()), "hits": bits, "spans": old["spans"] + runs, "items": sorted({*old["items"], *names})})
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit``, ``_hits`` (a bit a word, null if none is hit), ``_spans`` (start and end bytes of
    the hit runs in the original text, one after the other) and ``_items`` (ids whose windows occur, sorted).

    Names that ``docs`` has already get underscores behind them (:func:`added_names`).  No shuffle: each text passes
    each automaton once, where it is read.  Null text has no words; equal item ids count as one; an empty benchmark
    hits nothing; other columns pass through.
    """
    names = added_names(docs.columns)
    kinds = {name: to_arrow_type(kind) for name, kind in ADDED.items()}
    empty = {"n_words": "0L", "n_hit": "0L", "hits": "cast(null as binary)", "spans": "cast(array() as array<long>)", "items": "cast(array() as array<string>)"}
    out, at = docs.select("*", *[F.expr(value).alias(names[name]) for name, value in empty.items()]), docs.columns.index(text)
    for group in item_groups(benchmark, item, item_text):
        shipped = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value, width)
            for batch in batches:
                own = batch.num_columns - len(ADDED)
                before = [dict(zip(ADDED, row)) for row in zip(*(batch.column(own + k).to_pylist() for k in range(len(ADDED))))]
                found = _scanned(batch.column(at), matcher, before)
                added = [pa.array([f[name] for f in found], kind) for name, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:own], *added], names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out


def leak_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = scan(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), benchmark)
    return out.select(
        F.col("key").alias(key),
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        F.col("_hits").isNotNull().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no window of any item occurs, columns unchanged."""
    hits = added_names(docs.columns)["hits"]
    return scan(docs, benchmark, text).filter(F.col(hits).isNull()).select(*docs.columns)
