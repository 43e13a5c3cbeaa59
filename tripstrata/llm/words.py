"""Words of whole texts as numpy arrays: one pass over the bytes, no Python object per word.

Separators are ASCII, so UTF-8 can be split and lower-cased byte by byte.  Words are named by a 64-bit hash of
their bytes.  Words of the same length of up to eight bytes never share one; for two others, not made against it, the probability is about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are handled in slices of about this many bytes (a longer text alone), which bounds a worker's memory.
SLICE_BYTES = 1 << 20

_BYTES = np.arange(256)
#: `[^\x20\x09-\x0D]+`
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z is lower-cased
LETTERS_DIGITS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

#: Words up to this many bytes are hashed as a column of eight-byte pieces, longer ones one by one.
SHORT = 64
_PIECES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (the 64-bit finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, len(texts))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, wordlike: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it (one more at the end)."""
    inside = wordlike[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, wherever it stands: its pieces of eight bytes, mixed in one after the other."""
    data = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the piece that begins at each byte
    size = ends - starts
    out = mixed(size.astype(np.uint64) * _STEP + np.uint64(1))
    rows = np.flatnonzero((size > 0) & (size <= SHORT))
    for at in range(0, SHORT, 8):
        rows = rows[size[rows] > at]
        if not len(rows):
            break
        piece = eight[starts[rows] + at] & _PIECES[np.minimum(size[rows] - at, 8)]
        out[rows] = mixed((out[rows] ^ piece) * np.uint64(0x2545F4914F6CDD1D))
    for k in np.flatnonzero(size > SHORT):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return out


def chained(keys: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive keys, in order; shorter than ``keys`` by width - 1."""
    out = keys[: max(0, len(keys) - width + 1)]
    for k in range(1, width):
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + keys[k : k + len(out)])
    return out
