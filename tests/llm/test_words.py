"""Words are named soundly, whatever pattern their bytes follow."""

import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tripstrata.llm import bpe, counts, near, tokenstore, words


def mirrored(size, a="a", b="b"):
    """Two different words that every polynomial hash modulo a power of two takes for one."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_mirrored_words_have_different_hashes():
    for size in (8, 16, 64, 72, 1024, 2048):
        left, right = mirrored(size)
        data = np.frombuffer(f"{left} {right} {left}".encode(), np.uint8)
        starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.NOT_SPACE)
        a, b, c = words.hashes(data, starts, ends).tolist()
        assert a == c != b


def test_lengths_and_zeros_matter():
    pieces = [b"a", b"a\0", b"a\0\0", b"\0a", b"\0", b"a" * 8, b"a" * 9, b"a" * 64, b"a" * 65]
    data = np.frombuffer(b" ".join(pieces), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    assert len(set(words.hashes(data, ends - [len(p) for p in pieces], ends).tolist())) == len(pieces)


def test_operators_tell_mirrored_words_apart(spark):
    left, right = mirrored(1024)
    texts = [left, right, f"{right} {left}", f"{left} x {right}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(bpe.path())
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert {r["doc_id"]: r["n_tokens"] for r in counts.count_report(docs).collect()} == {i: len(x) for i, x in enumerate(ids)}
    crcs = {i: zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for i, x in enumerate(ids)}
    assert {r["doc_id"]: r["ids_crc32"] for r in tokenstore.token_report(docs).collect()} == crcs
    sets = list(near.shingle_sets(pa.array(texts[:2]), 1))
    assert sets[0].tolist() != sets[1].tolist()
