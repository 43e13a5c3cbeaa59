"""Removal of long repeated byte strings with suffix arrays sorted by the deep-shallow method.

Every string of ``LENGTH`` bytes has one anchor: the 32 bytes inside it with the smallest hash, the leftmost of
equals.  Equal strings have equal anchors at equal places, so repeats meet in the group of their anchor.  An
anchor's *segment* is the bytes of all strings that it stands for (400 to 768 bytes).  Spark counts segments
by anchor and by content:

* a segment that occurs again as a whole is a repeat throughout;
* an anchor with several different segments is a group whose members are compared: the texts' parts to the right
  of the anchor are sorted as suffixes, likewise the reversed parts to the left, and the tree of common prefixes on
  the right, with neighbours in the order of the left, gives each member its longest matches around the anchor;
* a group with more than ``MEMBERS`` different segments is not gathered: Spark counts 128-bit digests of blocks of
  its strings, and of single strings where a block is not yet decided.

Sorting is deep-shallow: multikey quicksort on eight bytes at a time down to ``SHALLOW`` bytes, then a blind trie
for suffixes that still agree, which have long common prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged
from .words import mixed, text_slices

LENGTH = 400
GRAM = 32
#: Bytes that multikey quicksort looks at before a group of suffixes goes to a blind trie.
SHALLOW = 64
#: Different segments of one anchor that one task compares (at most 768 bytes each).
MEMBERS = 1000
#: Bytes of text handled at a time; a position takes about 40 bytes of arrays.
SLICE = 1 << 19
#: A text longer than this is looked through in stretches.
STRETCH = 1 << 21

_KEYS = np.random.default_rng(400).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each place, by doubling."""
    out, width = _KEYS[data], 1
    while width < GRAM:
        out = out[:-width] * np.uint64(pow(_FACTOR, width, 1 << 64)) + out[width:]
        width *= 2
    return mixed(out)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first start, number of starts, place of the anchor, its hash) for runs of starts with one anchor.
    Places count from the first byte of ``data``."""
    empty = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return empty
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= length] or [np.zeros(0, np.int64)])
    if not len(starts):
        return empty
    grams, window = gram_hashes(data), length - GRAM + 1
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    blocks = np.concatenate((order, np.full(-len(order) % window, 2**64 - 1, np.uint64))).reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[starts], ahead[starts + window - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)))
    at = np.flatnonzero(new)
    first, place = starts[at], anchor[at]
    return np.searchsorted(offsets, first, "right") - 1, first, np.diff(np.append(at, len(starts))), place, grams[place]


def _long_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of one very long text, from stretches that overlap by a string.  A run that a stretch cuts in two is
    two runs: a string's anchor depends on its own bytes only."""
    parts = []
    for a in range(0, len(data) - length + 1, STRETCH):
        stretch = data[a : a + STRETCH + length - 1]
        text, first, starts, place, gram = anchor_runs(stretch, np.array([0, len(stretch)]), length)
        parts.append((text, first + a, starts, place + a, gram))
    return tuple(np.concatenate(x) for x in zip(*parts))


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix of two strings that agree on ``start`` bytes."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    differ = int.from_bytes(a[start:end], "big") ^ int.from_bytes(b[start:end], "big")
    return end - (differ.bit_length() + 7) // 8


def blind_trie_order(suffixes: list[bytes], items: list[int], agreed: int) -> list[int]:
    """``items`` in the order of their suffixes, which agree on the first ``agreed`` bytes.

    A node is [depth, children by the byte at depth]; a leaf is a list of items with equal suffixes.  A walk
    down looks at one byte a node only; one comparison with the leaf it ends in then finds the true place.
    """
    root: list | None = None

    def byte(i: int, depth: int) -> int:
        return suffixes[i][depth] if depth < len(suffixes[i]) else -1

    for i in items:
        if root is None:
            root = [None, [i]]
            continue
        node = root
        while node[0] is not None:
            node = node[1].get(byte(i, node[0])) or next(iter(node[1].values()))
        other = node[1][0]
        depth = common_prefix(suffixes[i], suffixes[other], agreed)
        if depth == len(suffixes[i]) == len(suffixes[other]):
            node[1].append(i)
            continue
        above, node = None, root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][byte(i, node[0])]
        if node[0] == depth:
            node[1][byte(i, depth)] = [None, [i]]
            continue
        split = [depth, {byte(i, depth): [None, [i]], byte(other, depth): node}]
        if above is None:
            root = split
        else:
            above[1][byte(i, above[0])] = split
    out, stack = [], [root] if root else []
    while stack:
        depth, below = stack.pop()
        if depth is None:
            out.extend(below)
        else:
            stack.extend(below[b] for b in sorted(below, reverse=True))
    return out


def deep_shallow_order(suffixes: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indexes of ``suffixes`` in their order; a prefix comes before its extensions."""
    out, stack = [], [(list(range(len(suffixes))), 0)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2:
            out.extend(items)
        elif depth >= shallow:
            out.extend(blind_trie_order(suffixes, items, depth))
        else:
            keys = [suffixes[i][depth : depth + 8] for i in items]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            same = [i for i, k in zip(items, keys) if k == pivot]
            stack.append(([i for i, k in zip(items, keys) if k > pivot], depth))
            stack.append((same, depth + 8 if len(pivot) == 8 else shallow))
            stack.append(([i for i, k in zip(items, keys) if k < pivot], depth))
    return out


def longest_matches(members: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For segments (bytes, place of the anchor): spans of each that also stand around another one's anchor and are
    at least ``length`` long."""
    right = [data[at:] for data, at in members]
    left = [data[:at][::-1] for data, at in members]
    order = deep_shallow_order(right)
    rank = {i: k for k, i in enumerate(deep_shallow_order(left))}
    shared = [common_prefix(right[i], right[j]) for i, j in zip(order, order[1:])]
    spans: list[list[tuple[int, int]]] = [[] for _ in members]

    def node(low: int, high: int, depth: int) -> None:
        """Members order[low:high] agree on ``depth`` bytes to the right."""
        inside = sorted(order[low:high], key=rank.__getitem__)
        for i, j in zip(inside, inside[1:]):
            back = common_prefix(left[i], left[j])
            if back + depth >= length:
                for k in (i, j):
                    spans[k].append((members[k][1] - back, members[k][1] + depth))

    reach, open_ = max(len(x) for x in left), []
    for k, depth in enumerate([*shared, -1]):  # intervals of common prefixes, closed as the prefix shortens
        low = k
        while open_ and open_[-1][1] > depth:
            low, deep = open_.pop()
            if deep + reach >= length:
                node(low, k + 1, deep)
        if depth >= 0 and (not open_ or open_[-1][1] < depth):
            open_.append((low, depth))
    return spans


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """(k1, k2, gram, name, first, starts, place): a row for each anchor of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(n).to_numpy() for n in ("k1", "k2"))
            for row, _, data, offsets in text_slices(batch.column("text"), SLICE):
                text, first, starts, place, gram = anchor_runs(data, offsets, length) if len(data) <= STRETCH else _long_runs(data, length)
                raw = data.tobytes()
                names = np.fromiter(
                    (xxhash.xxh3_64_intdigest(raw[a:b], seed=c) for a, b, c in zip(first.tolist(), (first + starts + length - 1).tolist(), (place - first).tolist())), np.uint64, len(first)
                )
                yield pa.RecordBatch.from_pydict(
                    {"k1": pa.array(k1[row + text]), "k2": pa.array(k2[row + text]), "gram": pa.array(gram.view(np.int64)), "name": pa.array(names.view(np.int64)),
                     "first": pa.array(first - offsets[text]), "starts": pa.array(starts.astype(np.int32)), "place": pa.array((place - first).astype(np.int32))}
                )

    return docs.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, gram long, name long, first long, starts int, place int")


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """Texts compressed for the shuffle, as ``z``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(map(pack, texts), pa.binary())], names=[*names, "z"])

    kinds = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.select(*names, "text").mapInArrow(run, f"{kinds}, z binary")


def _cut(frame: DataFrame, length: int) -> DataFrame:
    """Segments' bytes, from packed texts and the list of their segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k1, k2, z, cuts in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "z", "cuts"))):
                text = unpack(z)
                part = pa.Table.from_pylist(cuts, _CUTS)
                part = part.append_column("k1", pa.array([k1] * len(cuts), pa.int64())).append_column("k2", pa.array([k2] * len(cuts), pa.int64()))
                part = part.append_column("data", pa.array([text[c["first"] : c["first"] + c["starts"] + length - 1] for c in cuts], pa.binary()))
                yield from part.combine_chunks().to_batches()

    return frame.mapInArrow(run, "gram long, name long, first long, starts int, place int, variants long, repeated boolean, k1 long, k2 long, data binary")


_CUTS = pa.schema([("gram", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("starts", pa.int32()), ("place", pa.int32()), ("variants", pa.int64()), ("repeated", pa.bool_())])
SPANS = "k1 long, k2 long, low long, high long"


def _span_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "low", "high"])


def _compared(segments: DataFrame, length: int) -> DataFrame:
    """Spans of the segments that occur once, from comparison within their anchor's group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, members, out = None, {}, []

        def solve() -> None:
            rows = list(members.values())
            if len(rows) > 1:
                for r, spans in zip(rows, longest_matches([(r[4], r[3]) for r in rows], length)):
                    if not r[5]:
                        out.extend((r[0], r[1], r[2] + a, r[2] + b) for a, b in spans)

        for batch in batches:
            for g, name, *row in zip(*(batch.column(n).to_pylist() for n in ("gram", "name", "k1", "k2", "first", "place", "data", "repeated"))):
                if g != gram:
                    solve()
                    gram, members = g, {}
                members[name] = row
            yield _span_batch(out)
            out.clear()
        solve()
        yield _span_batch(out)

    return segments.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, SPANS)


_TESTS = "k1 long, k2 long, gram long, name long, low long, high long, block int, repeated boolean, core binary, whole binary"


def _block_tests(frame: DataFrame, length: int, size: int) -> DataFrame:
    """For blocks of ``size`` neighbouring strings of a segment: ``core``, a digest of the bytes that all of them
    hold, and ``whole``, of the bytes that any holds (null at the segment's ends).  Blocks count by the distance
    from a string's start to the anchor, so equal strings lie in equal blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = ("k1", "k2", "gram", "name", "first", "starts", "place", "data", "repeated", "blocks")
            for k1, k2, gram, name, first, starts, place, data, repeated, blocks in zip(*(batch.column(n).to_pylist() for n in names)):
                near, far = place - starts + 1, place  # distances of the last and the first start
                asked = [(b, repeated) for b in range(near // size, far // size + 1)] if blocks is None else [(x["block"], x["repeated"]) for x in blocks]
                for block, resolved in asked:
                    low, high = block * size, block * size + size - 1
                    tag = block.to_bytes(4, "little") + gram.to_bytes(8, "little", signed=True)
                    core = xxhash.xxh3_128_digest(tag + data[place - low : place - high + length])
                    inside = near <= low and high <= far
                    whole = xxhash.xxh3_128_digest(tag + data[place - high : place - low + length]) if inside else None
                    out.append((k1, k2, gram, name, first + place - min(high, far), first + place - max(low, near) + length, block, resolved, core, whole))
            columns = list(zip(*out)) or [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _TEST_KINDS)], names=[x.split()[0] for x in _TESTS.split(", ")])

    return frame.mapInArrow(run, _TESTS)


_TEST_KINDS = (pa.int64(),) * 6 + (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
#: Strings of a segment that are tested together, from level to level.
BLOCKS = (32, 8, 1)


def _counted(segments: DataFrame, length: int) -> DataFrame:
    """Spans of strings that occur again, for anchors with too many different segments to gather.

    Digests of blocks of strings are counted.  A block whose core is unique holds no repeat; one that occurs again
    as a whole is a repeat throughout; others are cut into smaller blocks, down to single strings.  Of equal
    blocks one goes on, for others to be compared with.
    """
    found, asked = [], segments.withColumn("blocks", F.lit(None).cast("array<struct<block:int,repeated:boolean>>"))
    for size, finer in zip(BLOCKS, (*BLOCKS[1:], None)):
        tests = staged(_block_tests(asked, length, size), "blocks")
        counts = lambda name: staged(tests.filter(f"{name} is not null").groupBy(name).agg(F.count("*").alias("n")).filter("n > 1").select(name), name)  # noqa: B023, E731
        live = tests.join(counts("core"), "core", "left_semi")
        if finer is None:
            return reduce(DataFrame.union, [*found, live.filter("not repeated").select("k1", "k2", "low", "high")])
        again = counts("whole").withColumn("again", F.lit(True))
        live = staged(live.join(again, "whole", "left"), "live")
        found.append(live.filter("again and not repeated").select("k1", "k2", "low", "high"))
        one = live.filter("again").groupBy("whole").agg(F.min(F.struct("gram", "name", "block")).alias("one")).select("one.*", F.lit(True).alias("repeated"))
        left = live.filter("again is null").select("gram", "name", "block", "repeated").union(one)
        cut = left.withColumn("block", F.explode(F.sequence(F.col("block") * (size // finer), (F.col("block") + 1) * (size // finer) - 1)))
        listed = cut.groupBy("gram", "name").agg(F.collect_list(F.struct("block", "repeated")).alias("blocks"))
        asked = _inside(segments.join(listed, ["gram", "name"]), finer)
    return found[0]


def _inside(asked: DataFrame, size: int) -> DataFrame:
    """Without blocks that hold none of a segment's strings."""
    near, far = F.col("place") - F.col("starts") + 1, F.col("place")
    return asked.withColumn("blocks", F.filter("blocks", lambda x: ((x["block"] + 1) * size > near) & (x["block"] * size <= far)))


def repeated_spans(docs: DataFrame, length: int = LENGTH, members: int = MEMBERS) -> DataFrame:
    """(k1, k2, low, high) of bytes covered by repeats, for texts named by ``keyed``; spans may overlap."""
    anchors = staged(_anchors(docs, length), "anchors")
    counts = anchors.groupBy("gram", "name").agg(F.count("*").alias("n"))
    groups = counts.groupBy("gram").agg(F.count("*").alias("variants"), F.sum("n").alias("total")).filter("total > 1").drop("total")
    status = counts.join(groups, "gram").select("gram", "name", (F.col("n") > 1).alias("repeated"), "variants")
    shared = staged(anchors.join(status, ["gram", "name"]), "shared")
    whole = shared.filter("repeated").select("k1", "k2", F.col("first").alias("low"), (F.col("first") + F.col("starts") + (length - 1)).alias("high"))
    several = shared.filter("variants > 1")
    one = F.min(F.struct("k1", "k2", "first", "starts", "place", "variants"))
    chosen = several.filter("repeated").groupBy("gram", "name").agg(one.alias("one")).select("gram", "name", "one.*", F.lit(True).alias("repeated"))
    needed = several.filter("not repeated").select("gram", "name", "k1", "k2", "first", "starts", "place", "variants", "repeated").unionByName(chosen)
    cuts = needed.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "name", "first", "starts", "place", "variants", "repeated")).alias("cuts"))
    # rows that share a name are cut once: their common strings are known to be repeated
    segments = staged(_cut(_packed(docs, "k1", "k2").dropDuplicates(["k1", "k2"]).join(cuts, ["k1", "k2"]), length), "segments")
    found = _compared(segments.filter(F.col("variants") <= members), length)
    many = segments.filter(F.col("variants") > members)
    if not many.isEmpty():
        found = found.union(_counted(many, length))
    return whole.union(found)


def named_spans(docs: DataFrame, length: int = LENGTH, members: int = MEMBERS) -> DataFrame:
    """(k1, k2, spans): each span once, however many rows share the name."""
    return repeated_spans(docs, length, members).distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k1, k2, key, text): hashes of key and text together name a row; rows equal in both share a result."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(F.col(key)).alias("k1"), F.xxhash64(filled).alias("k2"), F.col(key).alias("key"), filled.alias("text"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, members: int = MEMBERS, with_text: bool = True) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_text`` the remaining bytes as ``kept``.

    A byte goes if it lies in a string of ``length`` bytes that starts anywhere else too, in the same text or another;
    overlaps count, and all copies go.  Null text is empty; rows with equal or null keys stay apart and count as
    copies of each other; an empty table gives none.
    """
    rows = keyed(docs, key, text)
    spans = named_spans(rows, length, members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for z, found in zip(batch.column("z").to_pylist(), batch.column("spans")):
                data = unpack(z)
                runs = merged(found.values) if found.is_valid else []
                kept, at = [], 0
                for low, high in runs:
                    kept.append(data[at:low])
                    at = high
                kept = b"".join([*kept, data[at:]])
                for n, v in zip(out, (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    out[n].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = {"key": batch.column("key")} | {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)}
            yield pa.RecordBatch.from_pydict(columns if with_text else {n: c for n, c in columns.items() if n != "kept"})

    joined = _packed(rows, "k1", "k2", "key").join(spans, ["k1", "k2"], "left").select("key", "z", "spans")
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)


def merged(spans: pa.StructArray) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    low, high = (spans.field(n).to_numpy() for n in ("low", "high"))
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate(([True], low[1:] > high[:-1]))
    return list(zip(low[new].tolist(), high[np.append(np.flatnonzero(new)[1:] - 1, len(high) - 1)].tolist()))


def repeat_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return without_repeats(docs, key, text, with_text=False)
