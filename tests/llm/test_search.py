"""Ranked search against plain scoring of every document for every item."""

import collections
import math
import re

import numpy as np
import pytest
from corpus_rows import WORDS, docs, none, prose, rows  # noqa: F401

from tripstrata.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(i, prose(40 + i, 25)) for i in range(6)] + [(10, "ALPHA alpha1 é"), (11, None), (12, ""), (13, "nowhere at all"), (14, " ".join(WORDS)), (10, "zeta2 日本"), (None, "zeta3"), (15, "!!")]


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(rows, items, top):
    found = [(r[0], collections.Counter(terms(r[1]))) for r in rows]
    found = [(k, c, sum(c.values())) for k, c in found if c]
    n_docs, total = len(found), sum(n for *_, n in found)
    df = collections.Counter(t for _, c, _ in found for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for key, c, n in found:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, place + 1, s[3], -s[0]) for place, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r[n] for n in ("item_id", "rank", "doc_id", "score")) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    names = ("number", "key", "term", "terms", "score", "rank", "item")
    return spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", *[f"0 as `{n}`" for n in names])


@pytest.mark.parametrize("top", [1, 5, 50, 1000])
def test_equal_to_plain_scoring(docs, rows, items, top, monkeypatch):
    wide = docs.selectExpr("*", "1 as score", "2 as rank", "3 as item_id", "4 as term", "5 as counts", "6 as `number`")
    frame = S.search(wide, items, top=top)
    assert got(frame) == plain(rows, ITEMS, top)
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]


def test_small_shards_and_blocks_of_items(docs, rows, items):
    assert got(S.search(docs, items, top=5, shard_postings=20, block_terms=30)) == plain(rows, ITEMS, 5)


def test_empty_tables(docs, none, items):
    assert S.search(none, items).collect() == []
    assert S.search(docs, items.limit(0)).collect() == []
    assert S.search(docs, items.filter("text is null")).collect() == []


def test_ties_go_to_the_smaller_key(spark):
    copies = spark.createDataFrame([(i, "same words here") for i in range(300, 0, -1)] + [(0, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    found = S.search(copies.repartition(7), items, top=20).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in found) == [(i, i) for i in range(1, 21)]


def test_reads_stop_early_and_stay_exact():
    """Random impacts: the best are those of a full sum, and far fewer postings are read than there are."""
    random = np.random.default_rng(3)
    size, width = 20_000, 8
    doc, term, count = [], [], []
    for t in range(width):
        chosen = np.sort(random.choice(size, size // 2, replace=False))
        doc.append(chosen), term.append(np.full(len(chosen), t)), count.append(np.where(random.random(len(chosen)) < 0.002, 50, 1) + random.integers(0, 2, len(chosen)))
    doc, term, count = map(np.concatenate, (doc, term, count))
    length = random.integers(50, 100, size)
    scoring = S.Scoring.of(size, int(length.sum()), np.array([20, 30, 40, size // 2, size // 2, size // 2, size // 2, size // 2]))
    shard = S.Shard(length, doc, term, count, scoring)
    whole = np.bincount(doc, scoring.impacts(term, count, length[doc]).astype(np.float64), size).astype(np.int64)
    for top in (1, 10, 100):
        found, scores = shard.search(np.arange(width), top, np.zeros(0, np.int64))
        limit = np.sort(whole)[-top]
        assert set(np.flatnonzero(whole >= limit).tolist()) <= set(found.tolist())
        assert (scores == whole[found]).all()
    found, scores = shard.search(np.arange(width), 10, np.full(10, whole.max() + 1))
    assert len(found) == 0
