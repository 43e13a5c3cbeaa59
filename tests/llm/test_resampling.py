"""Importance resampling against a plain version: every feature's bytes hashed, every document scored alone."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
from corpus_rows import docs, none, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstrata.llm import resampling as R

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TARGET = [(1, "alpha1 BETA2 délta"), (1, "run the é"), (2, None), (None, ""), (3, "日本 zeta59 the of and")]


def plain(rows, target, longest=1, buckets=10_000, least=20, percent=10):
    def found(text):
        words = WORDS.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own, goal = [found(r[1]) for r in rows], [found(t) for _, t in target]
    s, t = (collections.Counter(b for _, fs in x for b in fs) for x in (own, goal))
    over, under = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for (doc_id, *_), (n_words, fs) in zip(rows, own):
        gains = [math.floor(1000 * math.log((t[b] + 1) * over / ((s[b] + 1) * under))) for b in fs]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((o for o in out if o[5] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0, -o[2], -o[1]))
    for place, o in enumerate(able[: percent * len(able) // 100]):
        o[4] = place + 1
    return sorted((tuple(o[:5]) for o in out), key=repr)


def got(frame):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect()), key=repr)


@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=9))
@settings(max_examples=80, deadline=None)
def test_runs_are_composed_from_neighbours(words):
    crc, length = np.array([zlib.crc32(w) for w in words], np.uint32), np.array([len(w) for w in words])
    for k, runs in R.feature_crcs(crc, length, 4):
        assert runs.tolist() == [zlib.crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]


def test_equal_to_the_plain_version(spark, docs, rows):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    frame = R.resample_report(docs, target)
    assert got(frame) == plain(rows, TARGET)
    assert [k for _, k in frame.drop("doc_id").dtypes] == ["bigint"] * 4
    every = R.Settings(percent=100, least_words=1)
    assert got(R.resample_report(docs, target, settings=every)) == plain(rows, TARGET, percent=100, least=1)


def test_longer_features_and_a_small_dictionary(spark, docs, rows):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    want = plain(rows, TARGET, longest=3, buckets=500, percent=50)
    for words in (0, 3, 1 << 16):
        few = R.Settings(longest=3, buckets=500, percent=50, dictionary_words=words, dictionary_word_bytes=6)
        assert got(R.resample_report(docs, target, settings=few)) == want


def test_empty_tables(spark, docs, rows, none):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    assert R.resample_report(none, target).collect() == []
    assert got(R.resample_report(docs, target.limit(0))) == plain(rows, [])


def test_drawn_documents_keep_their_columns(spark, docs, rows):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    wide = docs.selectExpr("*", "1 as _drawn", "2 as rank", "3 as score", "4 as weight", "5 as place", "6 as n_words", "7 as buckets", "8 as _at")
    drawn = R.resampled(wide, target)
    assert drawn.columns == wide.columns
    keys = {r[0] for r in plain(rows, TARGET) if r[4]}
    assert sorted((r["doc_id"], r["_drawn"], r["rank"]) for r in drawn.collect()) == sorted((r[0], 1, 2) for r in rows if r[0] in keys)


def test_equal_scores_go_to_the_smaller_id(spark):
    same = spark.createDataFrame([(i, "w " * 30) for i in (5, 3, 9, 1)] * 3, "doc_id long, text string")
    every = R.Settings(percent=100)
    ranks = sorted((r["rank"], r["doc_id"], r["score"]) for r in R.resample_report(same, same, settings=every).collect())
    assert [r for r, *_ in ranks] == list(range(1, 13))
    assert ranks == sorted(ranks, key=lambda r: (-r[2], r[1]))
