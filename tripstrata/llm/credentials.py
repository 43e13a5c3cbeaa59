"""Secrets in texts: a trigram inverted index picks the candidates of each rule, and the rule confirms them.

Texts are indexed where they are read, a segment of about a megabyte at a time: posting lists of the trigrams that
any rule asks for.  Each rule's Boolean query is answered by intersecting and uniting them, and its pattern runs
over the candidates' whole texts only.  Rules whose pattern has no mandatory trigram run over every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import free_name
from .trigrams import ALL, Index, Query, query_of, wanted_trigrams
from .words import text_slices


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # of which the length counts
    least: int = 1  # code points; shorter matches are dropped, after matching
    base: bool = False


# The three base rules.  A run of hex digits or of an access key is matched as a whole, so asking for
# its length inside the pattern finds the same runs without stopping at each short one.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
)

#: Formats of well-known services, and logins inside addresses.
RULES = BASE_RULES + (
    Rule("private_key", r"-----BEGIN (?:[A-Z]{2,16} ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i:bearer)\x20{1,8}[A-Za-z0-9._~+/-]{20,}"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]{1,256}:[^\x00-\x20/:@]{1,256}@"),
)


class Scanner:
    """The rules of one scan, with their queries."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), query_of(r.pattern, re.ASCII)) for r in rules]
        self.wanted, self.codes = wanted_trigrams(q for _, _, q in self.rules)

    def queries(self) -> dict[str, Query]:
        return {r.kind: q for r, _, q in self.rules}

    def segment(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """(start, end, number of the rule) of each secret, for each text of a segment, in this order."""
        index = Index(data, offsets, self.wanted, self.codes)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(index.size)]
        texts: dict[int, str] = {}
        for number, (rule, pattern, query) in enumerate(self.rules):
            for k in index.answer(query).tolist():
                if k not in texts:
                    texts[k] = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "surrogatepass")
                for m in pattern.finditer(texts[k]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[k].append((m.start(), m.end(), number))
        return [sorted(f, key=lambda x: (x[0], x[2])) for f in found]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find_secrets(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, name: str = "secrets") -> DataFrame:
    """``docs`` with the column ``name`` (underscores are added where it is taken): kind, start and end of each secret,
    by start and then by the order of the rules; code points, end exclusive.

    Matches of one rule do not overlap, those of different rules may.  No shuffle: a text is indexed and searched
    where it is read.  Null or empty text holds nothing; rows and other columns pass through as they are.
    """
    rules, name = tuple(rules), free_name(docs.columns, name)
    at = docs.columns.index(text)
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = scanner(rules)
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(at)):
                found = search.segment(data, offsets)
                spans = [[{"kind": rules[n].kind, "start": a, "end": b} for a, b, n in f] for f in found]
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, spans_type)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, SPANS)]))


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256 and spans ("kind:start:end", comma-joined)."""
    found = find_secrets(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), rules=rules)

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    base = [r.kind for r in rules if r.base]
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select(F.col("key").alias(key), *counts, F.sha2(line(of(*base)), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))
