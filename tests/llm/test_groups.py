"""Near duplicates, embedding links, language model, page text, quality and the pipeline against brute force."""

import collections
import math
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import docs, none, rows  # noqa: F401

import corpus_pipeline
from tripstrata.llm import eliasfano, graph, lm, near, pagetext, quality, queries, scratch, vectors

SPACE = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    w = lowered(text)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def smallest_reachable(nodes, links):
    above = {n: n for n in nodes}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_near(rows, width):
    sets = {r[0]: shingles(r[1], width) for r in rows if r[0] is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, smallest_reachable(sets, links)


@pytest.mark.parametrize("options", [{}, {"block": 3, "hubs": 1}])
def test_near_duplicates_against_brute_force(docs, rows, options):
    got = near.near_duplicates(docs, settings=near.Settings(shingle=4, **options)).collect()
    sets, components = brute_near(rows, 4)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), components[r["doc_id"]], components[r["doc_id"]] == r["doc_id"])
    kept = near.deduplicated(docs, settings=near.Settings(shingle=4, **options))
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(r[0] for r in rows if r[0] is None or components[r[0]] == r[0])


@pytest.mark.parametrize("options", [{}, {"block": 2, "hubs": 1}])
def test_a_key_with_another_row_without_words_links_by_its_text(spark, options):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(i, f"{text} end{i}") for i in range(6)] + [(i, t) for i in (0, 3, 5) for t in (None, "", " \t")]
    for order in (rows, rows[::-1]):
        got = near.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").coalesce(1), settings=near.Settings(**options)).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in got if r["n_shingles"]) == [(i, 0) for i in range(6)]
        assert len(got) == len(rows)


def test_chain_of_near_copies_is_one_component_in_blocks(spark):
    """Neighbours of the chain are links, its ends are not: hubs must go on until nothing is left."""
    words = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(25):
        texts.append(" ".join(words[i * 4 : i * 4 + 100]))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    expected = brute_near(rows, 5)[1]
    got = near.near_duplicates(docs, settings=near.Settings(block=4, hubs=2)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected and set(expected.values()) == {0}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40, 60)] + [(1, 99), (99, 50), (7, 8), (5, 5)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = smallest_reachable({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in expected.items() if n != 5}
    assert graph.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def crooked_vectors():
    r = np.random.default_rng(1)
    centre = r.standard_normal((6, 16))
    rows = []
    for i in range(400):
        v = centre[i % 6] + r.standard_normal(16) * (0.25 if i % 3 else 2.0)
        rows.append((i, v.astype(np.float32).tolist(), i % 2))
    rows += [(500 + i, rows[3][1], 1) for i in range(5)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1), (603, rows[3][1], None), (604, [1.0] * 15 + [None], 1), (605, rows[3][1][:8], 1)]
    rows += [(606, [float("inf")] * 16, 1), (607, [], 1), (None, rows[3][1], 1), (3, rows[3][1], 1)]
    return rows


def test_components_in_one_forest_and_by_rounds(spark, monkeypatch):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(1, 300) if i % 60] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)]
    expected = {i: n for i, n in smallest_reachable({i for e in edges for i in e}, edges).items() if any(i in e and e[0] != e[1] for e in edges)}
    frame, written = spark.createDataFrame(edges, "a long, b long").repartition(7), []
    monkeypatch.setattr(graph, "staged", lambda frame, name: written.append(name) or scratch.staged(frame, name))
    assert {r["node"]: r["label"] for r in graph.components(frame).collect()} == expected
    assert written == ["forest", "labels"]  # no rounds over all partitions for few edges
    assert {r["node"]: r["label"] for r in graph.components(frame, task_edges=10).collect()} == expected
    assert len(written) > 4


@pytest.mark.parametrize("options", [{}, {"block": 16}, {"bucket": 20, "block": 30}])
def test_vector_links_against_brute_force(spark, options):
    rows = crooked_vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as dim", "2 as name", "3 as id")
    got = vectors.vector_links(frame, **options).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v, float), c) for i, v, c in rows if i is not None and v and None not in v and c is not None and np.isfinite(v).all() and any(v)]
    links, total = collections.Counter(), []
    for (a, u, c), (b, v, d) in combinations(good, 2):
        if c == d and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
            links.update((a, b) if a != b else (a,) * 1)
            total.append((a, b))
    components = smallest_reachable({r[0] for r in rows if r[0] is not None}, total)
    if options.get("bucket"):  # several tables find nearly all links, and join nothing that is not linked
        named = [r for r in got if r["vec_id"] is not None]
        assert all(components[r["component_id"]] == components[r["vec_id"]] for r in named)
        assert sum(r["component_id"] == components[r["vec_id"]] for r in named) >= 0.95 * len(named)
    else:
        for r in got:
            if r["vec_id"] == 3:
                continue  # occurs twice
            assert (r["n_links"], r["component_id"]) == ((links[r["vec_id"]], components[r["vec_id"]]) if r["vec_id"] is not None else (0, None)), r
    assert sum(r["n_links"] for r in got if r["vec_id"] != 3) >= 0.9 * sum(n for i, n in links.items() if i != 3)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)


def test_very_large_and_very_small_vectors_link(spark):
    r = np.random.default_rng(7)
    base = r.standard_normal((3, 16))
    rows = [(10 * i + k, (v * scale).tolist(), 1) for i, v in enumerate(base) for k, scale in enumerate((1.0, 1e200, 1e-200, -1e200))]
    rows += [(90, (base[0] * 1e200 + base[1] * 1e198).tolist(), 1), (91, (base[2] * 1e200).tolist(), 2)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    units = {i: (np.array(v) / np.abs(v).max(), c) for i, v, c in rows}
    for i, (u, c) in units.items():
        near = [j for j, (v, d) in units.items() if j != i and c == d and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93]
        assert got[i] == (len(near), min([i, *near])), i


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(2)
    a, b = r.standard_normal((2000, 64)), r.standard_normal((2000, 64))
    b = 0.93 * a / np.linalg.norm(a, axis=1)[:, None] + b * 0.05
    unit = [x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b)]
    code, factor = vectors.codes(unit[1].astype(np.float32))
    true = np.einsum("ij,ij->i", *unit)
    error = np.einsum("ij,ij->i", unit[0] @ vectors.rotation(64), code) / factor - true
    spread = np.sqrt((1 - factor**2) / factor**2 * (1 - true**2) / 63)
    assert abs(error.mean()) < 4 * error.std() / math.sqrt(2000)
    assert 0.9 < (error / spread).std() < 1.1 and np.abs(error / spread).max() < vectors.SURE


@pytest.mark.parametrize("dim", [16, 33, 64, 300])
def test_stored_codes_leave_no_close_pair_out(dim):
    r = np.random.default_rng(dim)
    a = r.standard_normal((600, dim))
    b = a + r.standard_normal((600, dim)) * r.uniform(0, 1, (600, 1))
    may = vectors.open_pairs(vectors.encoded(a), vectors.encoded(b), dim)
    cosine = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
    assert may[cosine >= 0.93].all() and (cosine >= 0.93).sum() > 50
    if dim >= 64:  # far pairs are told apart by codes alone
        assert may[cosine < 0.5].mean() < 0.02
    code = vectors.encoded(a)
    assert code["signs"].nbytes + code["levels"].nbytes <= 600 * (dim * 5 / 8 + 2)


def test_elias_fano():
    r = np.random.default_rng(0)
    for n, universe in ((0, 10), (1, 1), (1000, 10), (3000, 2**63), (20000, 2**40)):
        v = np.sort(r.integers(0, universe, n, dtype=np.uint64))
        coded = eliasfano.EliasFano.build(v, universe)
        asked = np.concatenate((v, r.integers(0, universe, 500, dtype=np.uint64), v + np.uint64(1)))
        assert (coded.access(np.arange(n)) == v).all()
        assert (coded.successor(asked) == np.searchsorted(v, asked)).all()


def test_language_model_against_brute_force(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", 50)
    got = lm.lm_report(docs).collect()
    assert len(got) == len(rows)
    kept, d = [lowered(r[1]) + [None] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2], 0.75
    one = collections.Counter(x for w in kept for x in w)
    two, three = ({k: n for k, n in collections.Counter(g for w in kept for g in zip(*(w[i:] for i in range(k)))).items() if n > 1} for k in (2, 3))
    total, size, below = sum(one.values()), len(one), collections.defaultdict(lambda: [0, 0])
    for g, n in [*two.items(), *three.items()]:
        below[g[:-1]][0] += 1
        below[g[:-1]][1] += n
    left = lambda h, c: (c - below[h][1] + d * below[h][0]) / c

    def p(*g):
        if len(g) == 1:
            return (max(one[g[0]] - d, 0) + d * size / (size + 1)) / total
        c = one[g[0]] if len(g) == 2 else two.get(g[:2], 0)
        own = (two if len(g) == 2 else three).get(g, 0)
        return p(*g[1:]) if not c else max(own - d, 0) / c + left(g[:-1], c) * p(*g[1:])

    by_text = {(r[0], r[1] if r[1] is not None else ""): r[1] for r in rows}
    found = collections.defaultdict(list)
    for r in got:
        found[r["doc_id"]].append(r)
    for (i, text) in by_text:
        w = lowered(text) + [None]
        base = sum(math.log10((one[x] + 1) / (total + size + 1)) for x in w)
        score = sum(math.log10(p(*w[max(0, k - 2) : k + 1])) for k in range(len(w)))
        assert any(
            (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(one[x] > 0 for x in w), total)
            and r["base_score"] == pytest.approx(base, rel=1e-9)
            and r["score"] == pytest.approx(score, abs=2e-4 * len(w))
            for r in found[i]
        )


def test_registered_language_model_keeps_pairs_and_triples_that_occur_once(spark, tmp_path):
    texts = {i: f"w{i} x{i} y{i}" for i in range(30)}
    held = next(i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2)
    seen = next(i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2)
    texts[held] = texts[seen]
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.op9_language_model(spark, str(tmp_path)).collect()}
    n = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in texts)  # texts trained on: n ends and 3 n other words
    word, end = 0.25 / (4 * n), (n - 0.75) / (4 * n)
    rest = 0.75 * (3 * n + 1) / (3 * n + 2) / (4 * n)
    back = lambda low: 0.25 + 0.75 * low
    first, second, last = word + rest, back(word + rest), back(end + rest)
    expected = sum(map(math.log10, (first, second, back(second), back(last))))
    assert got[held] == pytest.approx(expected, abs=2e-3) and got[held] == got[seen]
    assert got[held] > {r["doc_id"]: r["score"] for r in lm.lm_report(frame).collect()}[held] + 1


def test_language_model_of_nothing(spark, none):
    assert lm.lm_report(none).isEmpty()
    only_held_out = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert {(r["n_known"], r["train_tokens"]) for r in lm.lm_report(only_held_out).collect()} == {(0, 0)}


MENU = '<div id="x"><a href="/a">Home</a> <a href="/b">All about us</a></div>'


def page(i, host="h.example", body=None):
    body = body or f"<p>Text {i} &amp; more.\n <b>bold</b><br>line<p>Second &#8212; {i}</p>"
    return (i, f"https://{host}/{i}", f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>menu</nav>{MENU}<h1>Head {i}</h1>{body}<div>Same note on all pages</div><script>if (a</p>)</script><footer>f</footer></body></html>")


def test_templates_go_and_articles_stay(spark):
    rows = [page(i) for i in range(20)] + [page(100 + i, "other.example") for i in range(3)]
    rows += [(200, None, None), (201, "https://h.example/x", ""), (202, "no url", "just text &lt;here&gt;"), (203, "https://h.example/z", "<article><h1>A</h1><div class='comments'>no</div><p>yes<p>and</article><p>out"), (None, None, "<p>x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as subtrees", "3 as text")
    for limit in (pagetext.BROADCAST_TEMPLATES, 0):
        got = {r["page_id"]: (r["text"], r["n_chars"]) for r in pagetext.main_text(frame, limit=limit).collect()}
        assert len(got) == len(rows)
        assert got[3][0] == "Head 3\nText 3 & more. bold line\nSecond — 3"
        assert got[101][0].endswith("Second — 101\nSame note on all pages")  # too few pages to know
        assert got[200] == ("", 0) and got[201] == ("", 0) and got[202][0] == "just text <here>" and got[203][0] == "A\nyes\nand" and got[None][0] == "x"
        assert all(n == len(t) for t, n in got.values())
    assert pagetext.main_text(frame.limit(0)).isEmpty()


def test_copies_of_a_page_are_no_template(spark):
    rows = [page(i) for i in range(10)] + [(50 + i, "https://h.example/c", page(999)[2]) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in pagetext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[55] == "Head 999\nText 999 & more. bold line\nSecond — 999"


@pytest.mark.parametrize("html", ["<", "<p", "<!--", "a<b>c</i></b></p></div>", "<script>x", "<table><tr><td>a<td>b<tr><td>c</table>", '<p title="a>b">ok', "<p title='x>ok", "<" * 3000, "<div>" * 3000 + "x", "<ul><li>a<li>b</ul>"])
def test_broken_markup_never_fails(html):
    assert isinstance(pagetext.Page(html).blocks(), list)


def labelled(spark, n=400):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        words = [r.choice(["the", "of", "runs", "house", "green"]) + ("" if good else r.choice(["!!", "$$$"])) for _ in range(r.randrange(3, 60))]
        rows.append((i, " ".join(words if good else [w.upper() for w in words])))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in quality.quality_report(docs, labels).collect()}
    held = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(g["held_out"] for g, _ in held) and sum(g["held_out"] for g in got.values()) == len(held)
    assert np.mean([g["predicted"] == y for g, y in held]) > 0.97
    flipped = labels.selectExpr("doc_id", "case when crc32(encode(cast(doc_id as string), 'utf-8')) % 5 = 0 then 1 - quality else quality end as quality")
    again = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, flipped).collect()}
    assert again == {i: g["score"] for i, g in got.items()}  # held-out labels teach nothing


def test_quality_of_crooked_rows(spark, docs, rows, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (401, 0), (200, 1), (200, 0)], "doc_id long, quality int")
    got = quality.quality_report(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert {r["score"] for r in quality.quality_report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_report(none, labels).isEmpty()
    assert quality.good_documents(docs, labels).columns == docs.columns


def test_fitting_holds_the_sample_once(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{r.randrange(5000)}" for _ in range(1500))) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    before, held = pa.total_allocated_bytes(), []

    def fit(sample, settings):
        held.append((pa.total_allocated_bytes() - before, sum(s.nbytes + v.nbytes for s, v, _ in sample)))
        assert [y for _, _, y in sample] == [i % 2 for i, _ in rows]
        return quality.Model(settings, np.zeros(1), 0.0)

    monkeypatch.setattr(quality, "fit_ftrl", fit)
    quality.fit(frame, labels)
    assert held[0][1] > 1_000_000 and held[0][0] < 1.5 * held[0][1]


def test_pipeline_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, scratch.staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == names
        texts = lambda f: {(r["doc_id"], r["text"]) for r in f.select("doc_id", "text").collect()}
        old, new = texts(before), texts(docs)
        assert new <= old
        if name == "near_duplicates":
            _, components = brute_near(sorted(old), 5)
            assert new == {(i, t) for i, t in old if components[i] == i}
        if name == "benchmark":
            items = [lowered(re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", " ", r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            grams = {tuple(w[k : k + 10]) for w in items for k in range(len(w) - 9)}
            words = {i: lowered(re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", " ", t)) for i, t in old}
            assert {i for i, _ in new} == {i for i, w in words.items() if not grams & {tuple(w[k : k + 10]) for k in range(len(w) - 9)}}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last))
