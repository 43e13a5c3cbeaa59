"""Mixing, repeats, token files, decontamination, counts against brute force on crooked rows."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import docs, none, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstrata.llm import bpe, counts, leaks, mixing, prefixes, repeats, tokenstore, words

SPACE = r"[^\x20\x09-\x0D]+"


def pairs(frame, *names):
    return [tuple(r[n] for n in names) for r in frame.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_of_slices(texts):
    found = []
    for row, end, data, offsets in words.text_slices(pa.array(texts, pa.string()), 20):
        starts, ends, before = words.spans(data, offsets, words.NOT_SPACE)
        for a, b in zip(before[:-1], before[1:]):
            found.append([data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])])
    assert found == [re.findall(SPACE, t or "") for t in texts]


def test_hash_names_a_word_wherever_it_stands():
    data = np.frombuffer(b"ab xx ab ba ab", np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.NOT_SPACE)
    h = words.hashes(data, starts, ends)
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def test_targets_stop_at_the_limit_and_reshare():
    goal = mixing.targets({"a": 10, "b": 1000, "c": 500, None: 90}, (3, 1, 2), Fraction(3, 2), 2)
    assert goal["a"] == 20 and goal[None] == 180 and sum(goal.values()) == pytest.approx(2400)
    assert all(goal[s] <= 2 * n for s, n in {"a": 10, "b": 1000, "c": 500, None: 90}.items())


def test_mix_comes_near_its_targets(spark, docs, rows):
    got = pairs(mixing.mix_report(docs), "doc_id", "size", "source_size", "target", "taken")
    assert len(got) == len(rows)
    assert ordered((i, n) for i, n, *_ in got) == ordered((r[0], len(re.findall(SPACE, r[1] or ""))) for r in rows)
    assert all(taken <= 2 * size for _, size, _, _, taken in got)
    largest = max(n for _, n, *_ in got)
    by_source = collections.defaultdict(lambda: [0, 0, 0])
    for _, size, whole, target, taken in got:
        by_source[whole, target][0] += taken
    assert all(abs(taken - target) <= largest for (_, target), (taken, _, _) in by_source.items())
    assert ordered(got) == ordered(pairs(mixing.mix_report(docs.repartition(2)), "doc_id", "size", "source_size", "target", "taken"))
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(SPACE, t or "")) for (t,) in pairs(mixed, "text")) == sum(g[4] for g in got)


def test_smaller_budget_takes_a_subset(docs):
    few, many = (collections.Counter(x for x, in pairs(mixing.mixture(docs, share=share), "doc_id")) for share in (Fraction(1, 3), Fraction(2, 3)))
    assert not few - many


def test_long_texts_are_handled_in_stretches(monkeypatch):
    r = random.Random(1)
    data = np.frombuffer(bytes(r.choice(b"ab  ") for _ in range(3000)), np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.NOT_SPACE)
    whole = words.hashes(data, starts, ends)
    monkeypatch.setattr(words, "SLICE_BYTES", 7)
    assert (words.hashes(data, starts, ends) == whole).all()
    monkeypatch.setattr(repeats, "STRETCH", 500)
    once, cut = repeats.anchor_runs(data, np.array([0, len(data)]), 100), repeats._long_runs(data, 100)
    each = lambda runs: [(p, a) for f, n, a in zip(runs[1], runs[2], runs[3]) for p in range(f, f + n)]
    assert each(once) == each(cut)


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        hit = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                hit[p : p + length] = True
        runs = int(np.sum(np.diff(np.concatenate(([0], hit.astype(int)))) == 1))
        out.append((len(b), int(hit.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~hit])).hexdigest()))
    return out


@pytest.mark.parametrize("members", [repeats.MEMBERS, 1])
def test_repeats_against_brute_force(spark, docs, rows, members):
    rows = [r for r in rows if r[0] != 405]  # too long for brute force
    got = repeats.without_repeats(docs.filter("doc_id is null or doc_id <> 405"), members=members, length=200, with_text=False)
    expected = [(r[0], *b) for r, b in zip(rows, brute_repeats([r[1] for r in rows], 200))]
    assert ordered(pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(expected)


def test_rows_that_share_a_name_give_each_span_once(spark):
    text = " ".join(f"word{i}" for i in range(200))
    docs = spark.createDataFrame([(None, text)] * 30 + [(1, "x" + text)], "doc_id long, text string")
    for r in repeats.named_spans(repeats.keyed(docs, "doc_id", "text"), 200).collect():
        assert len(r["spans"]) == len(set(r["spans"]))
    got = pairs(repeats.repeat_report(docs), "doc_id", "n_bytes", "n_removed")
    assert ordered(got) == ordered([(None, len(text), len(text))] * 30 + [(1, len(text) + 1, len(text))])


@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), max_size=30), st.sampled_from([0, 8, 16]))
@settings(max_examples=100, deadline=None)
def test_deep_shallow_order(suffixes, shallow):
    got = repeats.deep_shallow_order(suffixes, shallow)
    assert sorted(got) == list(range(len(suffixes)))
    assert [suffixes[i] for i in got] == sorted(suffixes)


def test_deep_groups_go_through_blind_tries():
    r = random.Random(3)
    stem = bytes(r.randrange(256) for _ in range(300))
    suffixes = [stem[: r.randrange(100, 300)] + bytes(r.randrange(4) for _ in range(r.randrange(5))) for _ in range(300)]
    assert [suffixes[i] for i in repeats.deep_shallow_order(suffixes)] == sorted(suffixes)


def test_pieces_are_encoded_as_the_library_does(rows):
    texts = [r[1] for r in rows] + ["it's <|endoftext|>x İstanbul ſ ×÷ K ᾳ é  nb　sp DON'T", "<|startoftext|>"]
    got = [n for _, _, _, c in bpe.encoded(pa.array(texts, pa.string()), bpe.path()) for n in c.tolist()]
    ids = np.concatenate([i for _, _, i, _ in bpe.encoded(pa.array(texts, pa.string()), bpe.path())])
    whole = [e.ids for e in bpe.load(bpe.path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == [len(w) for w in whole] and ids.tolist() == [i for w in whole for i in w]


def test_store_that_forgets_gives_the_same_ids():
    small = bpe.PieceStore(bpe.path(), kept=5)
    for text in ("aa bb cc dd ee ff", "gg aa hh bb"):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.NOT_SPACE)
        assert small.encode(data, starts, ends)[0].tolist() == bpe.load(bpe.path()).encode(text, add_special_tokens=False).ids


def test_runs_of_marks_are_encoded_once():
    library = bpe.Tokenizer.from_file(bpe.path())

    class Counted:
        asked = []

        @property
        def model(self):
            return self

        def tokenize(self, part):
            self.asked.append(part)
            return library.model.tokenize(part)

    pieces = ["one,", "Two,", "three,", '."', "caf\u00c9,", "one"]
    assert bpe.encode_pieces(Counted(), pieces) == [library.encode(p, add_special_tokens=False).ids for p in pieces]
    assert Counted.asked.count(",") == 1


def test_pieces_that_meet_in_the_table_are_told_apart():
    store = bpe.PieceStore(bpe.path())
    r = random.Random(6)
    keys = np.array([7 << 48 | i for i in range(1, 400)] + [0, 2**64 - 1] + [r.randrange(2**64) for _ in range(200_000)], np.uint64)
    keys = np.unique(keys)
    number = np.arange(len(keys))
    for some in np.array_split(np.random.default_rng(7).permutation(len(keys)), 9):
        store._put(keys[some], number[some], np.ones(len(some), np.int32))
    at = store._found(keys)
    assert (store.first[at] == number).all() and (store.count[at] == 1).all() and (store.count >= 0).sum() == len(keys)
    assert (store.count[store._found(keys[5:9] + np.uint64(1 << 20))] < 0).all()


def test_counts_and_every_prefix(docs, rows):
    encode = lambda t: bpe.load(bpe.path()).encode(t, add_special_tokens=False).ids
    got = pairs(counts.count_report(docs), "doc_id", "n_bytes", "n_tokens", "over_limit")
    expected = [(r[0], len((r[1] or "").encode()), len(encode(r[1] or ""))) for r in rows]
    assert ordered(got) == ordered((*e, e[2] > 2048) for e in expected)
    for r in counts.prefix_counts(docs.filter("doc_id in (1, 200, 401, 403)")).collect():
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        table = counts.PrefixCounts(text, np.array(r["starts"]), np.array(r["ends"]), np.array(r["totals"]))
        by_prefix = [len(encode(text[:i])) for i in range(len(text) + 1)]
        assert [table.at(i) for i in range(len(text) + 1)] == by_prefix
        for budget in (0, 1, 7, 50, 10_000):
            assert by_prefix[table.fit(budget)] <= budget


PARTS = ["a", "b", "th", "ing", "tion", "'", "'re", "'ll", "'s", "'v", "r", "17", "!", "..", "e\u0301", "\u0323", "日本", "İ", "ſ", "\u00a0", "<|endoftext|>", "<|end", "|>", "\u1112\u1161\u11ab", "\x01", "😀"]


@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=9).map("".join))
@settings(max_examples=300, deadline=None)
def test_recurrence_counts_every_beginning_as_the_library_does(piece):
    expected = [len(e.ids) for e in bpe.load(bpe.path()).encode_batch_fast([piece[:i] for i in range(1, len(piece) + 1)], add_special_tokens=False)]
    assert prefixes.Recurrence.table(prefixes.recurrence(bpe.path()), piece) == expected


def test_stored_tables_answer_without_the_tokenizer(spark, monkeypatch):
    text = "It's <|endoftext|>x cafe\u0301 re'vel'd " + "ab" * 3000 + " end. "
    encode = lambda t: len(bpe.load(bpe.path()).encode(t, add_special_tokens=False).ids)
    expected = {i: encode(text[:i]) for i in [*range(60), *range(60, len(text) + 1, 397), len(text)]}
    r = counts.prefix_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    monkeypatch.setattr(bpe, "load", None)
    monkeypatch.setattr(bpe, "encode_pieces", None)
    table = counts.PrefixCounts(text, r["starts"], r["ends"], r["totals"], r["inside"], file="none")
    assert {i: table.at(i) for i in expected} == expected
    assert table.at(-1) == r["n_tokens"] and table.at(10**9) == r["n_tokens"] and table.fit(r["n_tokens"]) == len(text)
    assert all(table.at(table.fit(budget)) <= budget for budget in range(r["n_tokens"]))


def test_registered_counts_build_the_tables(monkeypatch):
    data = np.frombuffer(b"alpha beta17 alpha", np.uint8)
    starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.NOT_SPACE)
    store = prefixes.PrefixStore(bpe.path())
    monkeypatch.setattr(bpe, "encode_pieces", None)
    encode = lambda t: len(bpe.load(bpe.path()).encode(t, add_special_tokens=False).ids)
    assert store.counts(data, starts, ends).tolist() == [encode("alpha"), encode("beta17"), encode("alpha")]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_variable_length_codes(ids):
    control, data = tokenstore.pack(np.array(ids, np.uint32))
    assert tokenstore.unpack(control, data, len(ids)).tolist() == ids
    assert len(control) == -(-len(ids) // 4)


def test_token_files_hold_the_ids_in_order(spark, docs, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "BLOCK_IDS", 300)
    table = tokenstore.write_tokens(docs, str(tmp_path / "tokens"), file_documents=9)
    got = sorted(tokenstore.read_tokens(spark, table).collect(), key=lambda r: r["start"])
    assert len({f for f in (tmp_path / "tokens").glob("*.parquet")}) > 3
    assert [r["key"] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    encode = lambda t: bpe.load(bpe.path()).encode(t or "", add_special_tokens=False).ids + [2]
    assert ordered((r["key"], r["ids"], r["ids_crc32"]) for r in got) == ordered((r[0], ids := encode(r[1]), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in rows)
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])))[:-1].tolist()


def test_null_keys_are_spread_over_files(spark, tmp_path):
    rows = [(None, f"null {i}") for i in range(60)] + [(i, f"text {i}") for i in range(60)] + [(-(2**63), "lowest")]
    table = tokenstore.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "tokens"), file_documents=10)
    stored = spark.read.parquet(str(tmp_path / "tokens")).selectExpr("file", "explode(keys) as key").collect()
    most = max(collections.Counter(r["file"] for r in stored if r["key"] is None).values())
    assert len(stored) == len(rows) and most <= 25
    got = sorted(tokenstore.read_tokens(spark, table).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in got] == [None] * 60 + [-(2**63)] + list(range(60))


def brute_leaks(rows, items):
    tokens = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    for i, text in rows:
        w = tokens(text)
        hit, found = [False] * len(w), set()
        for item, t in items:
            v = tokens(t)
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if v and item is not None else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit[p : p + n] = [True] * n
                        found.add(str(item))
        yield i, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0


ITEMS = [(10, "Short!! item 1"), (9, None), (8, ""), (None, "x"), (10, "another SHORT one"), (2, "one two three four five six seven eight nine ten eleven twelve"), (3, "five six seven eight nine ten eleven twelve 13 14 15")]


@pytest.mark.parametrize("limit", [leaks.AUTOMATON_WORDS, 3])
def test_leaks_against_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(leaks.item_groups, "__defaults__", ("item_id", "text", limit))
    texts = ["a short, ITEM-1 b", "short item 11", ITEMS[5][1] + " 13 14 15", "x " + ITEMS[6][1].upper().replace(" ", "\n--"), None, "", "another short\tone another short one", "ten eleven twelve"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert ordered(pairs(leaks.leak_report(docs, bench), *names)) == ordered(brute_leaks(enumerate(texts), ITEMS))
    assert {i for i, in pairs(leaks.decontaminated(docs, bench), "doc_id")} == {1, 4, 5, 7}
    found = {r["doc_id"]: r["_spans"] for r in leaks.scan(docs, bench).collect() if r["_spans"]}
    assert texts[0].encode()[slice(*found[0][:2])] == b"short, ITEM-1"
    assert leaks.leak_report(docs, bench.limit(0)).filter("contaminated").isEmpty()


def test_empty_tables(spark, none):
    assert mixing.mix_report(none).isEmpty() and mixing.mixture(none).isEmpty()
    assert repeats.repeat_report(none).isEmpty()
    assert tokenstore.token_report(none).isEmpty()
    assert counts.count_report(none).isEmpty()
    assert leaks.leak_report(none, spark.createDataFrame(ITEMS, "item_id long, text string")).isEmpty()
