"""Token ids on disk: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

A file is a Parquet file that Spark writes and commits; each row is a block of whole documents in ascending key
order.  Ids are replaced by their rank by frequency over all documents, so most take one byte.  Four ranks share
a control byte that holds their byte lengths (0 to 3 for 1 to 4 bytes); control bytes and data bytes are separate
columns.  Decoding looks lengths up in a table of 256 rows and gathers with numpy, without a loop over ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .scratch import new_path
from .words import NOT_SPACE, spans, text_slices

END_ID = 2
#: A block closes after this many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 18
#: Documents a file, on average.
FILE_DOCUMENTS = 50_000

#: Byte lengths of four ranks by control byte, and their sum.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes); a last group of fewer than four is filled with zeros, one byte each."""
    ranks = np.concatenate((ranks.astype("<u4"), np.zeros(-len(ranks) % 4, "<u4")))
    size = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    control = size[0::4] | size[1::4] << 2 | size[2::4] << 4 | size[3::4] << 6
    used = np.arange(4) <= size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def pack_documents(ranks: np.ndarray, counts: np.ndarray, last: int) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of each document of a slice, packed at once; ``last`` ends each of them.

    ``ranks`` holds the documents one after the other, ``counts`` how many each has.  Every document begins with a
    control byte of its own, as in :func:`pack`.
    """
    groups = (counts + 1 + 3) // 4
    first = np.concatenate(([0], np.cumsum(groups)))  # control byte of each document
    start = first[:-1] * 4
    padded = np.zeros(int(first[-1]) * 4, "<u4")
    padded[np.arange(len(ranks)) + np.repeat(start - (np.cumsum(counts) - counts), counts)] = ranks
    padded[start + counts] = last
    size = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (size[0::4] | size[1::4] << 2 | size[2::4] << 4 | size[3::4] << 6).astype(np.uint8)
    data = padded.view(np.uint8).reshape(-1, 4)[np.arange(4) <= size[:, None]]
    ends = np.concatenate(([0], np.cumsum(LENGTHS[control].sum(axis=1))))[first]
    return tuple(
        pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())
        for cuts, values in ((first, control), (ends, data))
    )


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    source = np.frombuffer(data, np.uint8)
    first = np.cumsum(lengths) - lengths
    out = np.zeros(len(lengths), np.uint32)
    for k in range(4):
        more = lengths > k
        if not more.any():
            break
        out[more] |= source[first[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out[:count]


@dataclass(frozen=True)
class TokenTable:
    """Where the files are, and the id of each rank."""

    path: str
    by_rank: np.ndarray


def _frequencies(docs: DataFrame, text: str, file: str, end_id: int) -> np.ndarray:
    """Ids of the vocabulary, the most frequent first; counts are summed in tasks and then by Spark."""
    size = max(bpe.load(file).get_vocab_size(), end_id + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total[end_id] += batch.num_rows
            for _, _, data, offsets in text_slices(batch.column(0)):
                starts, ends, _ = spans(data, offsets, NOT_SPACE)
                total += bpe.store(file).id_counts(data, starts, ends, size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    counts = docs.select(text).mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, np.int64)
    total[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    return np.lexsort((np.arange(size), -total)).astype(np.uint32)


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", file: str | None = None, end_id: int = END_ID, file_documents: int = FILE_DOCUMENTS) -> TokenTable:
    """Encode every text, append ``end_id``, and write the files in ascending key order, null keys first.

    Two scans of the texts: one counts ids, one encodes.  What is shuffled is coded already.  Files are cut at
    quantiles of the key; a key that holds more than a file's documents, null too, is spread over its files by hash.
    """
    vocabulary = file or bpe.path()
    by_rank = _frequencies(docs, text, vocabulary, end_id)
    rank_of = np.empty(len(by_rank), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"))
    count = rows.count()
    files = max(1, -(-count // file_documents), min(count // 500, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lowest = np.iinfo(np.int64).min  # in place of null keys, which take their share of the cuts
    cuts = rows.select(F.percentile_approx(F.coalesce("key", F.lit(int(lowest))), [i / files for i in range(1, files)], 10 * files)).first()[0] if files > 1 else None
    cuts = np.array(cuts or [], np.int64)
    shipped = spark.sparkContext.broadcast((rank_of, cuts))  # the vocabulary, and a key a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, cuts = shipped.value
        for batch in batches:
            for row, end, ids, count in bpe.encoded(batch.column("text"), vocabulary):
                keys = batch.column("key").slice(row, end - row)
                numbers = pc.fill_null(keys, lowest).to_numpy()
                low, high = np.searchsorted(cuts, numbers, "left"), np.searchsorted(cuts, numbers, "right")
                low = np.where((numbers == lowest) & pc.is_valid(keys).to_numpy(zero_copy_only=False), high, low)  # behind all null keys
                control, packed = pack_documents(rank_of[ids], count, rank_of[end_id])
                file = low.copy()
                for k in np.flatnonzero(high > low):  # a key with several files
                    file[k] += zlib.crc32(packed[k].as_buffer()) % (high[k] - low[k] + 1)
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array(file, pa.int32()), "key": keys, "n": pa.array(count + 1, pa.int64()), "control": control, "data": packed}
                )

    coded = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "file int, key long, n long, control binary, data binary")
    in_order = coded.repartitionById(files, F.col("file")).sortWithinPartitions("file", F.col("key").asc_nulls_first(), "n", "data")
    in_order.mapInArrow(_blocks, "file int, block int, keys array<long>, counts array<long>, control binary, data binary").write.option("compression", "none").parquet(path)
    return TokenTable(path, by_rank)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order -> blocks.  Each document's codes start at a control byte of their own."""
    file, block, size, keys, counts, control, data = None, 0, 0, [], [], [], []

    def closed() -> pa.RecordBatch:
        columns = {"file": ([file], pa.int32()), "block": ([block], pa.int32()), "keys": ([keys], pa.list_(pa.int64())), "counts": ([counts], pa.list_(pa.int64())), "control": ([b"".join(control)], pa.binary()), "data": ([b"".join(data)], pa.binary())}
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for k, (v, t) in columns.items()})

    for batch in batches:
        for f, k, n, c, d in zip(*(batch.column(x).to_pylist() for x in ("file", "key", "n", "control", "data"))):
            if keys and (f != file or size >= BLOCK_IDS):
                yield closed()
                block = block + 1 if f == file else 0
                size, keys, counts, control, data = 0, [], [], [], []
            file, size = f, size + n
            keys.append(k)
            counts.append(n)
            control.append(c)
            data.append(d)
    if keys:
        yield closed()


def documents_of(counts: list[int], control: bytes, data: bytes, by_rank: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each document of a block, decoded at once."""
    groups = (np.array(counts, np.int64) + 3) // 4
    ids = by_rank[unpack(control, data, int(groups.sum()) * 4)]
    for first, n in zip((np.cumsum(groups) - groups) * 4, counts):
        yield ids[first : first + n]


def read_tokens(spark, table: TokenTable, with_ids: bool = True) -> DataFrame:
    """Per document, from the files: key, start (ids before it in key order), n_tokens, ids_crc32 and ``ids``."""
    blocks = spark.read.parquet(table.path)
    sizes = blocks.select("file", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("file").agg(F.sum("n").alias("n")).orderBy("file").collect()  # a row a file
    before = np.concatenate(([0], np.cumsum([r["n"] for r in totals]))).tolist()
    offsets = spark.createDataFrame([(r["file"], b) for r, b in zip(totals, before)], "file int, before long")
    places = sizes.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, "file").select("file", "block", (F.col("before") + F.col("inside")).alias("start"))
    shipped = spark.sparkContext.broadcast(table.by_rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("start", "keys", "counts", "control", "data")}
                counts = row["counts"].as_py()
                found = list(documents_of(counts, row["control"].as_py(), row["data"].as_py(), shipped.value))
                out = {"key": row["keys"].values, "start": pa.array(row["start"].as_py() + np.cumsum([0, *counts[:-1]]), pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())}
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))} if with_ids else {}))

    return blocks.join(places, ["file", "block"]).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def token_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files to the shared folder and report on what they hold: key, start, n_tokens, ids_crc32.

    Null text is encoded as empty, to the end id alone; equal keys stand side by side; an empty table gives none.
    """
    table = write_tokens(docs, new_path(docs.sparkSession, "tokens"), key, text)
    return read_tokens(docs.sparkSession, table, with_ids=False).withColumnRenamed("key", key)
