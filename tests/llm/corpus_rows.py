import random

import pytest

WORDS = ["alpha", "Beta", "gamma's", "délta", "é", "the", "of", "and", "run!!", "x-1", "日本", "zeta"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randrange(60)) if r.random() < 0.7 else "") for _ in range(n))


def crooked_rows():
    """Nulls in every column, empty and very long texts, copies, near copies, repeated rows."""
    base = [prose(i, 30 + i) for i in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[5], "en", "s0", 1) for i in range(12)]
    words = prose(99, 120).split()
    for i in range(10):
        changed = list(words)
        changed[i * 7] = f"changed{i}"
        rows.append((200 + i, " ".join(changed), "de", None, 2))
    passage = prose(7, 90)
    rows += [(300 + i, f"{prose(500 + i, 40)} {passage} {prose(700 + i, 30)}", "fr", "s1", 3) for i in range(6)]
    rows += [(400, None, None, None, None), (401, "", "en", "s2", 0), (402, " \t\n", "en", "s2", 3), (403, "one", "en", "s2", 3)]
    rows += [(404, "aaaa" * 3000, "en", "s1", 9), (405, prose(5, 20_000), "en", "s2", 9), (None, base[3], "en", "s0", 1), (None, None, None, None, None)]
    rows += [(7, base[7], "en", "s1", len(base[7]))] * 2  # repeated rows
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    return crooked_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns under names that operators use inside."""
    extra = ", ".join(f"'{n}' as `{n}`" for n in ("key", "k1", "size", "place", "bucket", "name", "label", "n", "z", "html", "file", "data", "_n_words", "_n_hit", "_HITS", "_spans", "_items", "_score", "_source", "_target", "_base", "_threshold", "_copies", "_copy", "_source_size", "row", "x", "y", "grp", "salt", "part"))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", *extra.split(", ")).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
