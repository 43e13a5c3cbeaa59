"""Token counts at every prefix.

The count of a prefix is the count up to its last whole piece plus the count of the piece's beginning; both come
from tables: running totals over the pieces of a text, and for each distinct piece the counts of its own
prefixes, which tasks compute by the recurrence of ``prefixes``.  Truncation and budget questions are then searches in these tables, without encoding the text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, prefixes
from .words import NOT_SPACE, spans, text_slices

#: A text with more tokens than this does not fit.
TOKEN_LIMIT = 2048


class PrefixCounts:
    """Counts of one text: ``ends`` (bytes) of its pieces, ``totals`` of tokens up to each end, and ``inside``, the
    counts of all beginnings of its pieces one after the other.  Without ``inside`` the recurrence builds it here.
    """

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, totals: np.ndarray, inside: np.ndarray | None = None, file: str | None = None):
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        self.starts, self.ends, self.totals = (np.asarray(a, np.int64) for a in (starts, ends, totals))
        self.chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character begins
        self.begins, self.stops = (np.searchsorted(self.chars, a) for a in (self.starts, self.ends))
        self.first = np.concatenate(([0], np.cumsum(self.stops - self.begins)))
        if inside is None:
            inside = prefixes.store(file or bpe.path()).encode(data, self.starts, self.ends)[0]
        self.inside = np.asarray(inside, np.int64)

    def _next(self, whole: int) -> tuple[int, np.ndarray]:
        """Tokens of the first ``whole`` pieces, and the counts of the next piece's beginnings."""
        return int(self.totals[whole - 1]) if whole else 0, self.inside[self.first[whole] : self.first[whole + 1]] if whole < len(self.starts) else self.inside[:0]

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters."""
        end = range(len(self.chars) - 1)[:chars].stop
        whole = int(np.searchsorted(self.stops, end, "right"))
        before, counts = self._next(whole)
        return before + int(counts[end - self.begins[whole] - 1]) if whole < len(self.starts) and self.begins[whole] < end else before

    def fit(self, budget: int) -> int:
        """The most characters that end with a whole piece, or inside the next one, within ``budget`` tokens."""
        whole = int(np.searchsorted(self.totals, budget, "right"))
        if whole == len(self.starts):
            return len(self.chars) - 1
        before, counts = self._next(whole)
        good = np.flatnonzero(before + counts <= budget)
        return int(self.begins[whole]) + (int(good[-1]) + 1 if len(good) else 0)


def prefix_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", file: str | None = None, totals: bool = True) -> DataFrame:
    """Per row: key, n_bytes, n_tokens, and with ``totals`` the tables ``starts``, ``ends`` (bytes) and
    ``totals`` (tokens) of its pieces and ``inside``, the counts of each piece's beginnings, from which ``PrefixCounts``
    answers.  Either way the tables of the distinct pieces are built, and n_tokens comes from their last entries.  Null text counts as empty; rows with
    equal or null keys stay apart; an empty table gives an empty result.
    """
    file = file or bpe.path()
    names = ("starts", "ends", "totals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1)):
                starts, ends, before = spans(data, offsets, NOT_SPACE)
                if totals:
                    inside, last, size = prefixes.store(file).beginnings(data, starts, ends)
                else:
                    last = prefixes.store(file).counts(data, starts, ends)
                running = np.concatenate(([0], np.cumsum(last)))
                out = {"key": batch.column(0).slice(row, end - row), "n_bytes": np.diff(offsets), "n_tokens": np.diff(running[before])}
                if totals:
                    owner = np.repeat(np.arange(end - row), np.diff(before))
                    lists = (starts - offsets[owner], ends - offsets[owner], running[1:] - running[before[owner]])
                    out |= {n: pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(v, pa.int64())) for n, v in zip(names, lists)}
                    chars = np.concatenate(([0], np.cumsum(size)))[before]
                    out["inside"] = pa.ListArray.from_arrays(pa.array(chars, pa.int32()), pa.array(inside, pa.int32()))
                yield pa.RecordBatch.from_pydict({n: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for n, v in out.items()})

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_tokens long" + (", starts array<long>, ends array<long>, totals array<long>, inside array<int>" if totals else "")
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def count_report(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per document: key, n_bytes, n_tokens, over_limit."""
    return prefix_counts(docs, key, text, totals=False).withColumn("over_limit", F.col("n_tokens") > limit)
