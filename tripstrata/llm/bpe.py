"""A public word-level BPE tokenizer over whole texts, encoding each distinct piece once.

The tokenizer's pattern never joins characters across white space and its normaliser works inside a piece, so the
ids of a text are those of its white-space-delimited pieces in order.  Pieces repeat; a batch's distinct ones
are found by their 64-bit hashes, encoded by the library and kept.  ``tests/llm`` compares with direct encoding.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from .words import NOT_SPACE, SLICE_BYTES, hashes, spans, text_slices

VOCABULARY = "word_bpe_49k.json"
#: Ids are kept for up to this many pieces, then the store starts anew: about 90 MB a worker.
KEPT_PIECES = 1_500_000


def path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load(file: str) -> Tokenizer:
    return Tokenizer.from_file(file)


#: Letters, then marks: pieces whose normal form and split are plain.  The byte-level alphabet shows printable
#: bytes as themselves and the others, in order, as the characters from 256 on.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*)([!-&(-/:-@\[-`{-~]*)")
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_AS_CHARACTER = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


#: Ids are kept for up to this many runs of marks, then anew.
KEPT_MARKS = 50_000


@lru_cache(maxsize=2)
def _marks(tokenizer: Tokenizer) -> dict[str, list[int]]:
    """Ids of runs of marks met lately, which are few.  One a worker process."""
    return {}


def encode_pieces(tokenizer: Tokenizer, pieces: list[str]) -> list[list[int]]:
    """Ids of pieces without white space.  Letters followed by marks go to the library's BPE model directly, in
    lower case; whatever else a piece holds goes through the whole tokenizer."""
    model, known, out, other = tokenizer.model, _marks(tokenizer), [], []
    for i, piece in enumerate(pieces):
        plain = _PLAIN.fullmatch(piece)
        ids: list[int] = []
        if plain:
            letters, marks = plain.groups()
            if letters:
                ids = [t.id for t in model.tokenize(letters.lower() if letters.isascii() else letters.lower().encode("utf-8").decode("latin-1").translate(_AS_CHARACTER))]
            if marks:
                if marks not in known:
                    if len(known) >= KEPT_MARKS:
                        known.clear()
                    known[marks] = [t.id for t in model.tokenize(marks)]
                ids = ids + known[marks]
        else:
            other.append(i)
        out.append(ids)
    if other:
        for i, e in zip(other, tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
    return out


class PieceStore:
    """Ids of pieces in one growing array, found by hash in an open-addressing table of numpy columns."""

    def __init__(self, file: str, kept: int = KEPT_PIECES):
        self.tokenizer, self.kept = load(file), kept
        self.clear()

    def clear(self) -> None:
        self.used, self.n_ids = 0, 0
        self.ids = np.zeros(1 << 16, np.int32)
        self._make(1 << 16)

    def _make(self, size: int) -> None:
        """An empty table of ``size`` places, a power of two: hash, first id, number of ids (-1: free)."""
        self.keys, self.first, self.count = np.zeros(size, np.uint64), np.zeros(size, np.int64), np.full(size, -1, np.int32)
        self.shift = np.uint64(64 - (size.bit_length() - 1))

    def listed(self, pieces: list[str]) -> list[list[int]]:
        """What is kept for each piece."""
        return encode_pieces(self.tokenizer, pieces)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, number of ids of each piece)."""
        at = self.places(hashes(data, starts, ends), data, starts, ends)
        first, count = self.first[at], self.count[at].astype(np.int64)
        before = np.cumsum(count)
        return self.ids[np.repeat(first - (before - count), count) + np.arange(int(before[-1]) if len(before) else 0)], count

    def id_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        """How often each id occurs."""
        return np.bincount(self.encode(data, starts, ends)[0], minlength=size)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.count[self.places(hashes(data, starts, ends), data, starts, ends)].astype(np.int64)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First id and number of ids of the distinct pieces, and each piece's index among them."""
        keys, example, which = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = self.places(keys, data, starts[example], ends[example])
        return self.first[at], self.count[at].astype(np.int64), which

    def places(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table's place of each piece, whose hashes are ``keys``; new pieces are encoded and put there."""
        if self.used > self.kept:
            self.clear()
        at = self._found(keys)
        new = np.flatnonzero(self.count[at] < 0)
        if len(new):
            fresh, example = np.unique(keys[new], return_index=True)
            example = new[example]
            raw = data.tobytes()
            lists = self.listed([raw[a:b].decode("utf-8") for a, b in zip(starts[example].tolist(), ends[example].tolist())])
            count = np.fromiter(map(len, lists), np.int32, len(lists))
            begin = self.n_ids + np.cumsum(count, dtype=np.int64) - count
            self._append(np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum(dtype=np.int64))))
            grown = self._put(fresh, begin, count)
            if grown:
                at = self._found(keys)
            else:
                at[new] = self._found(keys[new])
        return at

    def _append(self, ids: np.ndarray) -> None:
        need = self.n_ids + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.n_ids], np.zeros(max(need, 2 * len(self.ids)) - self.n_ids, np.int32)))
        self.ids[self.n_ids : need] = ids
        self.n_ids = need

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or the free one where its search ends."""
        at = (keys >> self.shift).astype(np.int64)
        on = np.flatnonzero((self.keys[at] != keys) & (self.count[at] >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (len(self.keys) - 1)
            on = on[(self.keys[at[on]] != keys[on]) & (self.count[at[on]] >= 0)]
        return at

    def _put(self, keys: np.ndarray, first: np.ndarray, count: np.ndarray) -> bool:
        """Put distinct keys that the table doesn't hold; whether it had to grow, which moves all places."""
        size, self.used = len(self.keys), self.used + len(keys)
        while 2 * self.used > size:
            size *= 2
        grown = size > len(self.keys)
        if grown:
            full = self.count >= 0
            keys, first, count = np.concatenate((self.keys[full], keys)), np.concatenate((self.first[full], first)), np.concatenate((self.count[full], count))
            self._make(size)
        while len(keys):
            at = self._found(keys)
            self.keys[at] = keys  # of keys that meet at one free place the last one stays
            here = self.keys[at] == keys
            self.first[at[here]], self.count[at[here]] = first[here], count[here]
            keys, first, count = keys[~here], first[~here], count[~here]
        return grown


@lru_cache(maxsize=2)
def store(file: str) -> PieceStore:
    """One store a worker process, kept between tasks."""
    return PieceStore(file)


def encoded(texts: pa.Array, file: str):
    """For slices of ``texts``: (first row, end row, ids, number of ids of each row)."""
    pieces = store(file)
    for row, end, data, offsets in text_slices(texts, SLICE_BYTES):
        starts, ends, before = spans(data, offsets, NOT_SPACE)
        ids, count = pieces.encode(data, starts, ends)
        total = np.concatenate(([0], np.cumsum(count)))
        yield row, end, ids, np.diff(total[before])
