"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector ``o`` is rotated at random and kept as its signs, ``c`` (a unit vector too), with the factor
``<c, o>``.  For another unit vector ``q``, ``<c, q> / <c, o>`` is an unbiased estimate of ``<o, q>`` over
rotations, and for a true value of t its error has a deviation of sqrt((1 - f**2) / f**2 * (1 - t**2) / (D - 1)).
``q`` is kept too, rotated and rounded to four bits an entry with a fixed dither, which keeps the estimate unbiased
and adds to its deviation.  Each vector is coded once, to five bits an entry and four numbers, and codes alone go
through the tables below.  Pairs whose estimate lies more than ``SURE`` deviations below the limit are dropped; the
vectors of the others are fetched, and these pairs computed again in double precision.

Pairs are looked for within tables of buckets.  A table's key is a few signs of random projections; their number
grows with the logarithm of a label's vectors, so buckets stay about the same size, and the number of tables
follows, so that a pair at the limit shares a bucket with a probability of ``RECALL``.  Equal vectors stand behind
one representative.  Buckets over ``BLOCK`` are compared block against block in tasks of their own, and results
leave a task as one row a vector: its number of links and its root in the task's forest of links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import Forest, components
from .scratch import staged

LIMIT = 0.93
RECALL = 0.995  # of pairs just at the limit, over the tables; closer ones are found more often
BUCKET = 512  # vectors of a bucket, about, where they lie at random
BLOCK = 1024
SURE = 4.5  # deviations; a true link falls below in 3 of a million estimates


def tables(bits: int, limit: float = LIMIT, recall: float = RECALL) -> int:
    """Tables that a pair at the limit needs, each keyed by ``bits`` signs."""
    together = (1 - math.acos(limit) / math.pi) ** bits
    return 1 if bits == 0 else math.ceil(math.log(1 - recall) / math.log(1 - together))


@lru_cache(maxsize=8)
def planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, count)).astype(np.float32)


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(10_000 + dim).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component near one: the same cosines, to the last bit,
    from norms that neither overflow nor vanish."""
    largest = np.abs(vectors).max(axis=1, initial=0.0)
    return np.ldexp(vectors, -np.frexp(largest)[1][:, None])


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (entries +-1/sqrt(D)) in the rotated frame, and the correction factors <c, o>."""
    turned = unit @ rotation(unit.shape[1])
    code = np.where(turned >= 0, 1, -1).astype(np.float32) / np.float32(math.sqrt(unit.shape[1]))
    return code, np.einsum("ij,ij->i", code, turned)


#: Levels of a rounded entry.
LEVELS = 16


@lru_cache(maxsize=8)
def dither(dim: int) -> np.ndarray:
    return np.random.default_rng(20_000 + dim).random(dim).astype(np.float32)


def encoded(vectors: np.ndarray) -> dict[str, np.ndarray]:
    """What is kept of each vector: ``signs`` (a bit an entry) and their ``factor``, and ``levels`` (four bits an entry)
    with the ``low`` and the ``step`` of its rounded entries."""
    unit = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    turned, dim = unit @ rotation(unit.shape[1]), unit.shape[1]
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (LEVELS - 1), np.finfo(np.float32).tiny)
    level = np.clip(np.floor((turned - low[:, None]) / step[:, None] + dither(dim)), 0, LEVELS - 1).astype(np.uint8)
    level = np.pad(level, ((0, 0), (0, dim % 2)))
    return {
        "signs": np.packbits(turned >= 0, axis=1),
        "factor": np.abs(turned).sum(axis=1) / np.float32(math.sqrt(dim)),
        "levels": level[:, 0::2] | level[:, 1::2] << 4,
        "low": low,
        "step": step,
    }


def open_pairs(left: dict[str, np.ndarray], right: dict[str, np.ndarray], dim: int, limit: float = LIMIT) -> np.ndarray:
    """Which pairs of two sides' codes can have a cosine of ``limit``: those whose estimate is not surely below."""
    if dim <= 8:  # too short for deviations to mean much
        return np.ones((len(left["signs"]), len(right["signs"])), bool)
    level = np.stack((left["levels"] & 15, left["levels"] >> 4), 2).reshape(len(left["levels"]), -1)[:, :dim]
    entries = left["low"][:, None] + left["step"][:, None] * level.astype(np.float32)
    signs = np.unpackbits(right["signs"], axis=1)[:, :dim].astype(np.float32) * 2 - 1
    factor = right["factor"]
    estimate = entries @ signs.T / (factor * np.float32(math.sqrt(dim)))
    turn = np.maximum(0, 1 - factor**2) / factor**2 * (1 - limit**2) / max(1, dim - 1)
    rounding = (left["step"] / 2) ** 2  # variance of a dithered entry, at most; the signs' weights add up to one
    spread = np.sqrt(turn[None, :] + rounding[:, None] / factor[None, :] ** 2)
    return estimate >= limit - SURE * spread - 1e-4


def close_pairs(left: np.ndarray, right: np.ndarray, limit: float = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with a cosine of at least ``limit``; all inputs in double precision."""
    scale = [np.linalg.norm(x, axis=1) for x in (left, right)]
    unit = [(x / n[:, None]).astype(np.float32) for x, n in zip((left, right), scale)]
    dim = left.shape[1]
    code, factor = codes(unit[1])
    estimate = (unit[0] @ rotation(dim)) @ code.T / factor
    spread = np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 * (1 - limit**2) / max(1, dim - 1))
    i, j = np.nonzero(estimate >= limit - SURE * spread - 1e-5) if dim > 8 else np.nonzero(np.ones_like(estimate))
    keep = []
    for a in range(0, len(i), 1 << 16):
        x, y = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        keep.append(np.einsum("ij,ij->i", left[x], right[y]) / (scale[0][x] * scale[1][y]) >= limit)
    good = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[good], j[good]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``name`` (digest of label and values; null for vectors that link with nothing) and ``dim``."""
    for batch in batches:
        names, dims = [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector")):
            values = None
            if vector.is_valid and label is not None and vector.values.null_count == 0:
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not (len(values) and np.isfinite(values).all() and values.any()):
                    values = None
            dims.append(0 if values is None else len(values))
            # adding zero turns -0.0 into 0.0
            names.append(None if values is None else xxhash.xxh3_128_digest(repr(label).encode() + b"\0" + (values + 0.0).tobytes()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.binary()), pa.array(dims, pa.int32())], names=[*batch.schema.names, "name", "dim"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).reshape(-1, dim) if len(column) else np.zeros((0, dim))


CODES = {"signs": pa.binary(), "levels": pa.binary(), "factor": pa.float32(), "low": pa.float32(), "step": pa.float32()}
_CODE_SCHEMA = "signs binary, levels binary, factor float, low float, step float"


def _rows_of(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], kind) if matrix.ndim == 2 else pa.array(matrix, kind)


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each table: the vector's code, ``tab``, ``bucket`` and the buckets of all tables, by which a pair is counted once."""
    for batch in batches:
        for dim, bits in sorted({*zip(batch.column("dim").to_pylist(), batch.column("bits").to_pylist())}):
            part = batch.filter(pa.array((batch.column("dim").to_numpy() == dim) & (batch.column("bits").to_numpy() == bits)))
            count = tables(bits)
            vectors = scaled(np.stack(part.column("vector").to_pylist()).astype(np.float64)) if part.num_rows else np.zeros((0, dim))
            kept = encoded(vectors)
            code = {name: _rows_of(kept[name], kind) for name, kind in CODES.items()}
            signs = vectors.astype(np.float32) @ planes(dim, max(1, bits * count)) >= 0
            found = np.zeros((part.num_rows, count), np.int32)
            for t in range(count):
                for k in range(bits):
                    found[:, t] |= signs[:, t * bits + k].astype(np.int32) << k
            seen = pa.array([row.tobytes() for row in found], pa.binary())
            for t in range(count):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in ("label", "dim", "id", "copies")), *code.values(), pa.array(np.full(part.num_rows, t), pa.int32()), pa.array(found[:, t]), seen],
                    names=["label", "dim", "id", "copies", *code, "tab", "bucket", "seen"],
                )


_WHERE = ("label", "dim", "tab", "bucket", "low_block", "high_block")


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes sorted by pair of blocks -> those rows, without their codes, that are in a pair which may be close."""
    key, parts = None, []

    def wanted() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        block, dim, same = rows.column("block").to_numpy(), key[1], key[4] == key[5]
        sides = [np.flatnonzero(block == b) for b in ((key[4],) if same else (key[4], key[5]))]
        left, right = sides[0], sides[-1]
        if not len(left) or not len(right):
            return

        def code(at):
            part = rows.take(pa.array(at))
            flat = {n: np.frombuffer(b"".join(part.column(n).to_pylist()), np.uint8).reshape(len(at), -1) for n in ("signs", "levels")}
            return flat | {n: part.column(n).to_numpy() for n in ("factor", "low", "step")}

        may = open_pairs(code(left), code(right), dim)
        if same:
            may = np.triu(may, 1)
        chosen = np.concatenate((left[may.any(axis=1)], right[may.any(axis=0)]))
        if len(chosen):
            yield from rows.select([*_WHERE, "block", "id", "copies", "seen"]).take(pa.array(np.unique(chosen))).to_batches()

    for batch in batches:
        columns = list(zip(*(batch.column(n).to_pylist() for n in _WHERE)))
        at = 0
        while at < len(columns):
            end = at + 1
            while end < len(columns) and columns[end] == columns[at]:
                end += 1
            if columns[at] != key:
                if parts:
                    yield from wanted()
                key, parts = columns[at], []
            parts.append(batch.slice(at, end - at))
            at = end
    if parts:
        yield from wanted()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors sorted by pair of blocks -> (id, links, root) of each task's pairs."""
    key, rows = None, []

    def solved():
        tab, low, high = key[2], key[4], key[5]
        sides = [[r for r in rows if r[0] == b] for b in ((low,) if low == high else (low, high))]
        left, right = sides[0], sides[-1]
        if not left or not right:
            return
        i, j = close_pairs(*(scaled(np.array([r[3] for r in s], np.float64)) for s in (left, right)))
        if low == high:
            i, j = i[i < j], j[i < j]
        if len(i) and tab:
            seen = [np.array([np.frombuffer(r[4], np.int32)[:tab] for r in s]) for s in (left, right)]
            new = ~(seen[0][i] == seen[1][j]).any(axis=1)
            i, j = i[new], j[new]
        if not len(i):
            return
        ids = [np.array([r[1] for r in s]) for s in (left, right)]
        copies = [np.array([r[2] for r in s], np.int64) for s in (left, right)]
        links, forest = {}, Forest()
        for own, other, near, far in ((0, 1, i, j), (1, 0, j, i)):
            total = np.bincount(near, copies[other][far], len(ids[own])).astype(np.int64)
            for k in np.flatnonzero(total):
                links[ids[own][k].item()] = links.get(ids[own][k].item(), 0) + int(total[k])
        # a pair joins two trees once; later pairs of the same two add nothing
        for a, b in zip(ids[0][i].tolist(), ids[1][j].tolist()):
            forest.join(a, b)
        yield pa.RecordBatch.from_pydict(
            {"id": pa.array(list(links), pa.int64()), "links": pa.array(list(links.values()), pa.int64()), "root": pa.array([forest.root(x) for x in links], pa.int64())}
        )

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in _WHERE]
        vectors = batch.column("vector")
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        cuts = np.cumsum([0, *columns[1]])
        for n, (k, block, vid, copies, seen) in enumerate(zip(zip(*columns), *(batch.column(c).to_pylist() for c in ("block", "id", "copies", "seen")))):
            if k != key:
                if key is not None:
                    yield from solved()
                key, rows = k, []
            rows.append((block, vid, copies, values[cuts[n] : cuts[n + 1]], seen))
    if key is not None:
        yield from solved()


def vector_links(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """Per vector: key, n_links (others of its label with a cosine of at least 0.93), component_id, kept.

    Vectors that are null, zero, or hold null or non-finite values, and those with a null label, link with nothing;
    vectors of different lengths are never compared.  Rows with a null key link with nothing and are kept.  An empty table gives none.
    """
    kind = rows.schema[vector].dataType.elementType.simpleString()
    label_kind = rows.schema[label].dataType.simpleString()
    base = rows.select(F.col(key).cast("long").alias("id"), F.when(F.col(key).isNotNull(), F.col(label)).alias("label"), F.col(vector).alias("vector"))
    named = staged(base.mapInArrow(_named, f"id long, label {label_kind}, vector array<{kind}>, name binary, dim int"), "vectors")
    full = named.filter("name is not null")
    distinct = full.groupBy("name").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    distinct = staged(distinct, "distinct-vectors")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / bucket))).cast("int")
    plan = distinct.groupBy("label", "dim").agg(bits.alias("bits"))
    spread = distinct.join(plan, ["label", "dim"]).select("label", "dim", "id", "copies", "vector", "bits")
    placed = staged(spread.mapInArrow(_bucketed, f"label {label_kind}, dim int, id long, copies long, {_CODE_SCHEMA}, tab int, bucket int, seen binary"), "buckets")
    where, order = ["label", "dim", "tab", "bucket"], list(_WHERE)
    sizes = placed.groupBy(*where).agg(F.count("*").alias("n")).filter("n > 1").select(*where, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    cut = placed.join(sizes, where).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"low_block": F.least("block", "other"), "high_block": F.greatest("block", "other")})
    coded = paired.select(*order, "block", "id", "copies", "seen", *CODES).repartition(*order).sortWithinPartitions(*order)
    asked = staged(coded.mapInArrow(_asked, f"label {label_kind}, dim int, tab int, bucket int, low_block int, high_block int, block int, id long, copies long, seen binary"), "asked")
    fetched = asked.join(distinct.select("id", "vector"), "id")
    found = fetched.select(*order, "block", "id", "copies", "vector", "seen").repartition(*order).sortWithinPartitions(*order).mapInArrow(_linked, "id long, links long, root long")
    found = staged(found, "vector-links")
    component = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    stats = distinct.select("name", "id", "copies").join(counts, "id", "left").join(component, F.col("id") == F.col("node"), "left")
    stats = stats.select("name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "id").alias("component_id"))
    linked = full.select("id", "name").join(stats, "name").select("id", "n_links", "component_id")
    alone = named.filter("name is null").select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
