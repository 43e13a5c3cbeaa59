"""Language-model scoring with an n-gram trie in Elias-Fano coding.

Level 1 holds the words, sorted by a 64-bit hash; a word's id is its place.  Level k holds the kept n-grams of k
words as one sorted sequence of ``parent * width + child``: the parent is the place of the first k-1 words in
level k-1, the child is the last word's id at level 2 and above that its *context-relative* rank, the place of
the last word among the successors of the context without its first word.  Monotone pointers give where a
parent's children begin.  Probabilities and back-off weights are quantised to 16 bits.

The corpus is counted by Spark: tasks count n-grams of the texts that they read, as sorted arrays packed by range of
their parents; a task merges each range, in order, and writes it as a file of the level in the shared folder.  Workers map
the files into memory and search them by successor search.  An n-gram is counted only if both n-grams one word shorter are kept,
which loses none with the asked count.  The model grows with the corpus and never passes through the driver.

Smoothing is interpolated absolute discounting, down to a uniform share over all words and the unknown one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .eliasfano import EliasFano
from .scratch import new_path
from .words import LOWER, NOT_SPACE, hashes, spans, text_slices

#: Hash of the token that ends every text.
END = np.uint64(0x00E0D0F0E0D0F0E1)
#: Entries of counts that a task holds before it packs them.
BUFFERED = 1_500_000
#: Bytes of text whose n-grams are looked up together; the more, the fewer distinct ones.
SLICE = 3 << 20
#: N-grams in one file of a level, about.
SHARD = 4_000_000
#: Steps of a quantised logarithm: log10 from -16 to 0.
STEPS = 4096


@dataclass(frozen=True)
class Settings:
    order: int = 3
    least: tuple[int, ...] = (1, 2, 2)  # times that an n-gram of each length must occur to be kept
    discount: float = 0.75


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return code / -float(STEPS)


# files


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays.  It appears under its name when complete, so a task that runs twice does no harm."""
    fs, name = pafs.FileSystem.from_uri(path)
    fs.create_dir(name.rpartition("/")[0], recursive=True)
    own = f"{name}.{TaskContext.get().taskAttemptId()}"
    table = pa.table({"name": list(arrays), "kind": [a.dtype.str for a in arrays.values()], "size": [a.nbytes for a in arrays.values()]})
    head = pa.BufferOutputStream()
    with pa.ipc.new_stream(head, table.schema) as writer:
        writer.write_table(table)
    head = head.getvalue().to_pybytes()
    with fs.open_output_stream(own) as out:
        out.write(np.array([len(head)], np.int64).tobytes() + head + bytes(-(8 + len(head)) % 8))
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).view(np.uint8).tobytes() + bytes(-a.nbytes % 8))
    fs.move(own, name)


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the shared folder is mounted and read where it is not."""
    fs, name = pafs.FileSystem.from_uri(path)
    data = np.memmap(name, np.uint8, "r").view(np.ndarray) if fs.type_name == "local" else np.frombuffer(fs.open_input_file(name).read(), np.uint8)
    size = int(data[:8].view(np.int64)[0])
    table = pa.ipc.open_stream(pa.py_buffer(data[8 : 8 + size].tobytes())).read_all().to_pydict()
    out, at = {}, 8 + size + -(8 + size) % 8
    for n, kind, nbytes in zip(table["name"], table["kind"], table["size"]):
        out[n] = data[at : at + nbytes].view(kind)
        at += nbytes + -nbytes % 8
    return out


def packed_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    """A byte a count; those of 255 and more stand beside, by place."""
    many = np.flatnonzero(counts >= 255)
    return {"counts": np.minimum(counts, 255).astype(np.uint8), "many": many, "more": counts[many].astype(np.int64)}


def unpacked_counts(file: dict[str, np.ndarray], places: np.ndarray) -> np.ndarray:
    out = file["counts"][places].astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = file["more"][np.searchsorted(file["many"], places[large])]
    return out


@dataclass(frozen=True)
class Level:
    """Files of a level: ``keys`` (first key of each), ``offsets`` (entries before each, and all at the end).

    What points to the next level has files of its own, each for the entries from one of ``cuts`` to the next."""

    paths: tuple[str, ...]
    keys: tuple[int, ...]
    offsets: tuple[int, ...]
    width: int  # of a child
    pointers: dict = field(default_factory=dict)  # of the next level: file by number
    cuts: tuple[int, ...] = ()
    starts: tuple[int, ...] = ()  # of the next level: children before each file's
    most: int = 0  # children of an entry

    def open(self) -> OpenLevel:
        return _opened(self.paths, self.keys, self.offsets, self.width, tuple(sorted(self.pointers.items())), self.cuts, self.starts)


class OpenLevel:
    def __init__(self, paths, keys, offsets, width, pointers, cuts, starts):
        self.files = [load(p) for p in paths]
        self.sequences = [EliasFano.of(f) for f in self.files]
        self.keys, self.offsets, self.width = np.array(keys, np.uint64), np.array(offsets, np.int64), width
        self.pointers = {k: load(p) for k, p in pointers}
        self.pointed = {k: EliasFano.of(p) for k, p in self.pointers.items()}
        self.cuts, self.starts = np.array(cuts, np.int64), np.array(starts, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted ``keys`` in the whole level, -1 where absent."""
        keys, out = keys.astype(np.uint64), np.full(len(keys), -1, np.int64)
        cuts = np.append(np.searchsorted(keys, self.keys), len(keys))
        for k in np.flatnonzero(np.diff(cuts)):
            mine = slice(cuts[k], cuts[k + 1])
            at = self.sequences[k].find(keys[mine] - self.keys[k])
            out[mine] = np.where(at >= 0, at + self.offsets[k], -1)
        return out

    def _each(self, places: np.ndarray, cuts: np.ndarray, files: dict, read: Callable, out: np.ndarray) -> np.ndarray:
        distinct, which = np.unique(places, return_inverse=True)
        ends, found = np.searchsorted(distinct, cuts), np.zeros(len(distinct), out.dtype)
        for k in np.flatnonzero(np.diff(ends)):
            if k in files:
                found[ends[k] : ends[k + 1]] = read(k, distinct[ends[k] : ends[k + 1]] - cuts[k])
        return found[which]

    def _values(self, places: np.ndarray, read: Callable, kind) -> np.ndarray:
        return self._each(places, self.offsets, dict(enumerate(self.files)), read, np.zeros(len(places), kind))

    def counts(self, places: np.ndarray) -> np.ndarray:
        return self._values(places, lambda k, i: unpacked_counts(self.files[k], i), np.int64)

    def codes(self, places: np.ndarray) -> np.ndarray:
        """Quantised probabilities."""
        return self._values(places, lambda k, i: self.files[k]["code"][i], np.uint16)

    def keys_at(self, places: np.ndarray) -> np.ndarray:
        return self._values(places, lambda k, i: self.sequences[k].access(i) + self.keys[k], np.uint64)

    def children(self, places: np.ndarray) -> np.ndarray:
        """Where the children of each entry begin in the next level."""
        return self._each(places, self.cuts, self.pointers, lambda k, i: self.pointed[k].access(i).astype(np.int64) + self.starts[k], np.zeros(len(places), np.int64))

    def backoff(self, places: np.ndarray) -> np.ndarray:
        """log10 of what is left for words that are no child; 0 for entries without children."""
        return restored(self._each(places, self.cuts, self.pointers, lambda k, i: self.pointers[k]["weight"][i], np.zeros(len(places), np.uint16)))


@lru_cache(maxsize=8)
def _opened(*args) -> OpenLevel:
    return OpenLevel(*args)


@dataclass(frozen=True)
class Model:
    levels: tuple[Level, ...]
    tokens: int
    settings: Settings

    @property
    def words(self) -> int:
        return self.levels[0].offsets[-1]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities by count: the discounted share, and an equal part of what the discount leaves."""
        kept = np.minimum(self.settings.discount, np.maximum(counts, 0))
        left = self.settings.discount * self.words if self.tokens else 1
        return (counts - kept + left / (self.words + 1)) / max(1, self.tokens)


# tokens of texts


def token_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, distinct hashes, index of each token among them, row of each token); every text ends in END."""
    for row, end, data, offsets in text_slices(texts, SLICE):
        data = LOWER[data]
        starts, ends, before = spans(data, offsets, NOT_SPACE)
        keys = np.insert(hashes(data, starts, ends), before[1:], END)
        distinct, which = np.unique(keys, return_inverse=True)
        yield row, end, distinct, which, np.repeat(np.arange(end - row), np.diff(before) + 1)


class Reader:
    """Ids, counts and places of n-grams of the tokens of a slice."""

    def __init__(self, model: Model):
        self.model, self.levels = model, [level.open() for level in model.levels]

    def words(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = self.levels[0].find(distinct)
        counts = np.zeros(len(ids), np.int64)
        counts[ids >= 0] = self.levels[0].counts(ids[ids >= 0])
        return ids, counts

    def keys(self, order: int, ids: np.ndarray, owner: np.ndarray, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(index of the last token, key) of the n-grams of this length whose parts one word shorter are kept.
        ``places[k]``: place at level k + 1 of the n-gram that ends with each token, or -1."""
        shorter = places[order - 2]
        ok = np.flatnonzero((shorter[1:] >= 0) & (shorter[:-1] >= 0) & (owner[1:] == owner[:-1])) + 1
        parent = shorter[ok - 1]
        child = shorter[ok] - (self.levels[order - 3].children(places[order - 3][ok - 1]) if order > 2 else 0)
        width = self.model.words if order == 2 else self.model.levels[order - 1].width if len(self.model.levels) >= order else None
        return ok, (parent, child) if width is None else parent.astype(np.uint64) * np.uint64(width) + child.astype(np.uint64)


def _place_all(reader: Reader, ids: np.ndarray, owner: np.ndarray, upto: int) -> list[np.ndarray]:
    places = [ids]
    for order in range(2, upto + 1):
        out = np.full(len(ids), -1, np.int64)
        ok, keys = reader.keys(order, ids, owner, places)
        if len(ok):
            distinct, which = np.unique(keys, return_inverse=True)
            out[ok] = reader.levels[order - 1].find(distinct)[which]
        places.append(out)
    return places


# counting


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _planes(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.uint64)


def counted(frame: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], bucket_of: Callable[[np.ndarray, int], np.ndarray], finish: Callable, schema: str, buckets: int) -> DataFrame:
    """Counts of 64-bit keys.  Tasks pack sorted keys and counts by bucket; one task merges each bucket and hands it
    to ``finish(bucket, keys, counts)``, which yields the rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held)))
            bucket = bucket_of(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                mine = order[cuts[b] : cuts[b + 1]]
                rows.append((b, compress(_planes(np.diff(keys[mine], prepend=np.uint64(0)))), compress(_planes(counts[mine]))))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))], names=["bucket", "keys", "counts"])

        for batch in batches:
            for keys, counts in keys_of(batch):
                held.append((keys, counts))
                size += len(keys)
                if size > 2 * BUFFERED:
                    held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > BUFFERED:
                        yield packed()
                        held, size = [], 0
        if size:
            yield packed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress, held, size, bucket = zstandard.ZstdDecompressor().decompress, [], 0, None
        for batch in batches:
            for bucket, keys, counts in zip(*(batch.column(n).to_pylist() for n in ("bucket", "keys", "counts"))):
                held.append((np.cumsum(_unplanes(decompress(keys)), dtype=np.uint64), _unplanes(decompress(counts)).astype(np.int64)))
                size += len(held[-1][0])
                if size > 2 * BUFFERED and len(held) > 8:
                    held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
        if held:
            yield from finish(bucket, *summed(*(np.concatenate(x) for x in zip(*held))))

    return frame.mapInArrow(pack, "bucket int, keys binary, counts binary").repartitionById(buckets, F.col("bucket")).mapInArrow(merge, schema)


_META = "shard int, path string, key decimal(20,0), n long, total long, pointers string, most long"


def _meta(shard: int, path: str, key: int, n: int, total: int, pointers: str | None = None, most: int = 0) -> pa.RecordBatch:
    from decimal import Decimal

    kinds = (pa.int32(), pa.string(), pa.decimal128(20, 0), pa.int64(), pa.int64(), pa.string(), pa.int64())
    names = ["shard", "path", "key", "n", "total", "pointers", "most"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((shard, path, Decimal(key), n, total, pointers, most), kinds)], names=names)


def _level(rows: list, width: int) -> Level:
    rows = sorted(rows, key=lambda r: r["key"])
    offsets = np.concatenate(([0], np.cumsum([r["n"] for r in rows]))).astype(np.int64).tolist()
    return Level(tuple(r["path"] for r in rows), tuple(int(r["key"]) for r in rows), tuple(offsets), width)


def _partitions(docs: DataFrame) -> int:
    return 1 << max(3, (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def _words(docs: DataFrame, path: str) -> tuple[Level, int]:
    def keys_of(batch):
        for _, _, distinct, which, _ in token_slices(batch.column(0)):
            yield distinct, np.bincount(which, minlength=len(distinct))

    def finish(bucket, keys, counts):
        name = f"{path}/1-{bucket}"
        save(name, EliasFano.build(keys - keys[0], int(keys[-1] - keys[0]) + 1).arrays() | packed_counts(counts))
        yield _meta(bucket, name, int(keys[0]), len(keys), int(counts.sum()))

    top = lambda keys, buckets: (keys >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)
    rows = counted(docs, keys_of, top, finish, _META, _partitions(docs)).collect()  # a row a file
    return _level(rows, 0), sum(r["total"] for r in rows)


def _next_level(docs: DataFrame, model: Model, order: int, path: str) -> Model:
    """Adds a level.  The entries of the level above are cut into equal ranges; all children of a range are counted in
    one task, in the order of their keys, so what is merged there *is* a file of the level and its pointers."""
    above, settings = model.levels[-1], model.settings
    entries = above.offsets[-1]
    if entries >= 1 << (31 if order == 2 else 32):
        raise ValueError("keys hold up to 2**31 words and 2**32 pairs; raise the counts from which n-grams are kept")
    least = settings.least[order - 1]
    buckets = max(_partitions(docs), -(-model.tokens // SHARD))
    cuts = [b * entries // buckets for b in range(buckets + 1)]
    # while they are counted, keys are parent * base + child; a context-relative rank is below 2**31
    base = np.uint64(model.words if order == 2 else 1 << 31)
    width = model.words if order == 2 else max(1, model.levels[order - 3].most)

    def keys_of(batch):
        reader = Reader(model)
        for _, _, distinct, which, owner in token_slices(batch.column(0)):
            ids, counts = reader.words(distinct)
            ids = np.where(counts >= least, ids, -1)[which]  # a rarer word is in no n-gram that is kept
            places = _place_all(reader, ids, owner, order - 1)
            _, keys = reader.keys(order, ids, owner, places)
            if isinstance(keys, tuple):
                keys = keys[0].astype(np.uint64) * base + keys[1].astype(np.uint64)
            yield np.unique(keys, return_counts=True)

    def bucket_of(keys, _):
        return np.searchsorted(np.array(cuts[1:-1], np.int64), (keys // base).astype(np.int64), "right")

    def finish(bucket, keys, counts):
        good = counts >= least
        keys, counts = keys[good], counts[good]
        if not len(keys):
            return
        parent, child = (keys // base).astype(np.int64), (keys % base).astype(np.int64)
        reader = Reader(model)
        first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        children, sums = np.diff(np.append(first, len(parent))), np.add.reduceat(counts, first)
        context = reader.levels[-1].counts(parent[first]).astype(np.float64)
        left = quantised(np.log10((context - sums + settings.discount * children) / context))
        if order == 2:
            lower = model.unigram(reader.levels[0].counts(child))
        else:
            last = (reader.levels[-1].keys_at(parent) % np.uint64(above.width)).astype(np.int64)
            lower = 10.0 ** restored(reader.levels[-1].codes(reader.levels[-2].children(last) + child))
        share = (counts - settings.discount) / np.repeat(context, children) + np.repeat(10.0 ** restored(left), children) * lower
        whole = parent.astype(np.uint64) * np.uint64(width) + child.astype(np.uint64)
        name = f"{path}/{order}-{bucket}"
        further = packed_counts(counts) if order < settings.order else {}  # contexts of the next level
        save(name, EliasFano.build(whole - whole[0], int(whole[-1] - whole[0]) + 1).arrays() | further | {"code": quantised(np.log10(np.minimum(1, share)))})
        size, at = cuts[bucket + 1] - cuts[bucket], parent[first] - cuts[bucket]
        totals, weight = np.zeros(size + 1, np.int64), np.zeros(size, np.uint16)
        totals[at + 1], weight[at] = children, left
        totals = np.cumsum(totals)
        save(f"{name}-pointers", EliasFano.build(totals, int(totals[-1]) + 1).arrays() | {"weight": weight})
        yield _meta(int(bucket), name, int(whole[0]), len(whole), len(whole), f"{name}-pointers", int(children.max()))

    rows = counted(docs, keys_of, bucket_of, finish, _META, buckets).collect()  # a row a file
    totals = {r["shard"]: r["total"] for r in rows}
    starts = np.concatenate(([0], np.cumsum([totals.get(k, 0) for k in range(buckets)]))).astype(np.int64).tolist()
    pointing = replace(above, pointers={r["shard"]: r["pointers"] for r in rows}, cuts=tuple(cuts), starts=tuple(starts), most=max((r["most"] for r in rows), default=0))
    return Model((*model.levels[:-1], pointing, _level(rows, width)), model.tokens, settings)


def train(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Model:
    """Count all texts (null: empty) and write the trie.  One scan of the texts for each level."""
    if not 1 <= settings.order <= 3:
        raise ValueError("n-grams of one to three words")
    path = new_path(docs.sparkSession, "lm")
    texts = docs.select(text)
    level, tokens = _words(texts, path)
    model = Model((level,), tokens, settings)
    for order in range(2, settings.order + 1):
        if not model.levels[-1].offsets[-1]:
            break
        model = _next_level(texts, model, order, path)
    return model


# scoring


def _scores(model: Model, texts: pa.Array) -> dict[str, np.ndarray]:
    reader, out = Reader(model), {n: [] for n in ("n_tokens", "n_known", "base_score", "score")}
    for row, end, distinct, which, owner in token_slices(texts):
        size = end - row
        ids, counts = reader.words(distinct)
        tokens = np.bincount(owner, minlength=size)
        out["n_tokens"].append(tokens)
        out["n_known"].append(np.bincount(owner, (counts > 0)[which], size).astype(np.int64))
        out["base_score"].append(np.bincount(owner, np.log10(counts + 1.0)[which], size) - tokens * np.log10(float(model.tokens + model.words + 1)))
        log = np.log10(model.unigram(counts))[which]
        often = model.settings.least[1] if len(model.levels) > 1 else 1  # a rarer word is in no pair and has no children
        places = _place_all(reader, np.where(counts >= often, ids, -1)[which], owner, len(model.levels))
        for order in range(2, len(model.levels) + 1):
            context = np.full(len(log), -1, np.int64)
            context[1:] = np.where(owner[1:] == owner[:-1], places[order - 2][:-1], -1)
            some = np.flatnonzero(context >= 0)
            log[some] += reader.levels[order - 2].backoff(context[some])
            found = np.flatnonzero(places[order - 1] >= 0)
            log[found] = restored(reader.levels[order - 1].codes(places[order - 1][found]))
        out["score"].append(np.bincount(owner, log, size))
    return {n: np.concatenate(v) if v else np.zeros(0) for n, v in out.items()}


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % folds == fold, F.lit(False))


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scores(model, batch.column(1))
            columns = {"key": batch.column(0), "n_tokens": pa.array(found["n_tokens"].astype(np.int64)), "n_known": pa.array(found["n_known"].astype(np.int64)), "train_tokens": pa.array(np.full(batch.num_rows, model.tokens), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {n: pa.array(found[n].astype(np.float64)) for n in ("base_score", "score")})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumnRenamed("key", key)


def lm_report(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Train on the rows that are not held out and score all.  Null texts hold the end alone; rows with a null key
    are trained on; an empty table gives none."""
    model = train(docs.filter(~held_out(F.col(key))), text, settings)
    scored = score_texts(docs, model, key, text)
    return scored.withColumn("held_out", held_out(F.col(key)))
