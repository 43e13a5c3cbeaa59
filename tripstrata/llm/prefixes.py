"""Exact token counts of every beginning of a piece, by a recurrence over its characters.

A sequence of tokens is what BPE makes of its text if and only if that holds for each two neighbours.  So the last
token of a beginning is the one token that ends there and may stand after the last token of the beginning before
it: with ``last`` and ``count`` kept for each position, the next position follows from the positions up to one
token's length back.  A word's last symbol carries the end-of-word mark; each beginning is a word's end
too, so each position has a second, marked last token, which follows from the same unmarked ones.

Around it, the tokenizer's normaliser and word pattern are followed character by character: letters, single
digits, marks, contractions (undecided until their last letter is there) and special tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import normalizers

from . import bpe

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
UNDECIDED = {"'r", "'v", "'l"}
LETTER, NUMBER, MARK, SPACE = range(4)
#: Positions of a word up to this one are remembered by the word's beginning, for words to come.
SHORT = 24
#: Beginnings and pairs of tokens remembered; then they are forgotten: up to some 200 MB a worker.
REMEMBERED = 600_000

#: Pieces of printable ASCII without apostrophes, and their words once in lower case.
_ASCII = re.compile(r"[!-&(-~]*")
_WORDS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")


class Recurrence:
    def __init__(self, file: str):
        self.tokenizer = bpe.load(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if not suffix or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": PATTERN}:
            raise ValueError("the recurrence follows the word pattern and end-of-word mark of word-level BPE only")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {a + b for a, b in merges}
        base = [t for t in model["vocab"] if t not in made]
        #: Tokens are numbered in the order of their merges; single symbols come first and are their own parts.
        self.parts = [(k, k) for k in range(len(base))]
        self.merged: dict[tuple[int, int], int] = {}
        number = {t: k for k, t in enumerate(base)}
        marked = [len(t) > 1 for t in base]
        for a, b in merges:
            self.merged[number[a], number[b]] = number[a + b] = len(self.parts)
            self.parts.append((number[a], number[b]))
            marked.append(marked[number[b]])
        self._sound: dict[int, bool] = {}
        #: Tokens by text, within a word and at its end (-1: none); one that BPE never makes of its own text is in no word.
        self.texts: dict[str, list[int]] = {}
        for t, k in number.items():
            if self.sound(k):
                self.texts.setdefault(t[: -len(suffix)] if marked[k] else t, [-1, -1])[marked[k]] = k
        self.longest = max(map(len, self.texts))
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))) or r"(?!)")
        self.normal, self.composed = self.tokenizer.normalizer.normalize_str, normalizers.NFC().normalize_str
        self._apart: dict[tuple[int, int], bool] = {}
        self._known: dict[str, tuple[int, int, int]] = {}
        self._lowered: dict[str, str] = {}
        self._symbols: dict[str, tuple[str, int]] = {}

    # tokens

    def sound(self, token: int) -> bool:
        """Whether BPE makes this one token of the token's own text."""
        if (found := self._sound.get(token)) is None:
            a, b = self.parts[token]
            # its parts stay whole and apart until their own merge is the next one
            found = self._sound[token] = a == b == token or (self.sound(a) and self.sound(b) and self._split(a, b, token))
        return found

    def apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves these two as they are, side by side."""
        if (found := self._apart.get((a, b))) is None:
            if len(self._apart) >= REMEMBERED:
                self._apart.clear()
            found = self._apart[a, b] = self._split(a, b, len(self.parts))
        return found

    def _split(self, a: int, b: int, limit: int) -> bool:
        """Undo the merges of both sides, the latest first: no merge across the border may come before one undone.
        Of equal merges the left one comes first."""
        merged, parts = self.merged, self.parts
        while True:
            if merged.get((a, b), limit) < limit:
                return False
            if a > b:
                left = parts[a][0] != a or parts[a][1] != a
            else:
                left = parts[b] == (b, b)
            if left:
                if parts[a] == (a, a):
                    return True
                limit, a = a, parts[a][1]
            else:
                if parts[b] == (b, b):
                    return True
                limit, b = b + 1, parts[b][0]

    def step(self, tail: str, last: list[int], count: list[int]) -> tuple[int, int, int]:
        """(last token, number of tokens, number if the word ends here) of a word that ends in ``tail``, from the
        lists for its shorter beginnings; both lists start with the empty one."""
        size, seen, inner, final = len(tail), self._apart, None, None
        for k in range(max(0, size - self.longest), size):
            tokens = self.texts.get(tail[k:])
            if tokens is None:
                continue
            before = len(last) - size + k
            if inner is None and (token := tokens[0]) >= 0 and (before == 0 or (ok := seen.get((last[before], token))) or (ok is None and self.apart(last[before], token))):
                inner = token, count[before] + 1
                if final is not None:
                    break
            if final is None and (token := tokens[1]) >= 0 and (before == 0 or (ok := seen.get((last[before], token))) or (ok is None and self.apart(last[before], token))):
                final = count[before] + 1
                if inner is not None:
                    break
        return *inner, final

    def ends(self, word: str) -> list[int]:
        """Counts of ``word[:1]``, ``word[:2]``, ..., each as a word; symbols are the byte-level alphabet's."""
        last, count, out, known = [-1], [0], [], self._known
        for i in range(1, len(word) + 1):
            head = word[:i] if i <= SHORT else ""
            found = known.get(head)
            if found is None:
                found = self.step(word[max(0, i - self.longest) : i], last, count)
                if head:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[head] = found
            last.append(found[0])
            count.append(found[1])
            out.append(found[2])
        return out

    # characters

    def character(self, c: str) -> tuple[str, int]:
        """Symbols and kind of a normalised character, as the tokenizer's own pattern sees it."""
        if (found := self._symbols.get(c)) is None:
            words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}!")]
            symbols = "".join(words)[1:-1]
            kind = SPACE if not symbols else NUMBER if len(words) == 3 else LETTER if len(words[0]) > 1 else MARK
            found = self._symbols[c] = symbols, kind
        return found

    def lowered(self, c: str) -> str:
        """A composed character as the normaliser leaves it."""
        if (found := self._lowered.get(c)) is None:
            found = self._lowered[c] = self.normal(c)
        return found

    def table(self, piece: str) -> list[int]:
        """Counts of ``piece[:1]``, ``piece[:2]``, ... up to the whole piece, which has no ASCII white space."""
        out, total, at = [], 0, 0
        if _ASCII.fullmatch(piece) and "<|" not in piece:
            for word in _WORDS.findall(piece.lower()):
                out += [total + n for n in self.ends(word)] if total else self.ends(word)
                total = out[-1]
            return out
        for found in self.special.finditer(piece):
            low, high = found.span()
            part = self._plain(piece[at : high - 1])  # a special token is one only when its last character is there
            out += [total + n for n in part]
            total += (part[low - at - 1] if low > at else 0) + 1
            out.append(total)
            at = high
        return out + [total + n for n in self._plain(piece[at:])]

    def _plain(self, text: str) -> list[int]:
        state, out, i = _Words(self), [], 0
        if self.composed(text) == text:  # then so are all beginnings
            if "'" not in text:
                return self._undoubted(text)
            for c in text:
                state.feed(self.lowered(c))
                out.append(state.tokens())
            return out
        while i < len(text):
            j = i + 1
            while j < len(text) and _joins(text[j]):
                j += 1
            mark = state.mark()
            for k in range(i + 1, j + 1):
                state.reset(mark)
                state.feed(self.normal(text[i:k]))
                out.append(state.tokens())
            i = j
        return out


    def _undoubted(self, text: str) -> list[int]:
        """Composed text without apostrophes: a word is known as one when it begins."""
        counts, places, total, kind, word = [0], [], 0, SPACE, []  # counts after each normalised character
        stops: list[int] = []  # symbols of the word up to each of its characters

        def close() -> None:
            nonlocal total
            if word:
                found = self.ends("".join(word))
                counts.extend(total + found[n - 1] for n in stops)
                total += found[-1]
                word.clear()
                stops.clear()

        for c in text:
            for part in self.lowered(c):
                symbols, now = self.character(part)
                if now != kind or now == NUMBER:
                    close()
                    kind = now
                if kind == SPACE:
                    counts.append(total)
                else:
                    word.append(symbols)
                    stops.append(len(symbols) + (stops[-1] if stops else 0))
            places.append(len(counts) - 1 + len(stops))
        close()
        return [counts[k] for k in places]


@lru_cache(maxsize=10_000)
def _joins(c: str) -> bool:
    """Whether normalisation may change what stands before this character."""
    return unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or "ᄀ" <= c <= "ᇿ" or "\U00016d60" <= c <= "\U00016d6f"


class _Words:
    """The words of a text that grows: tokens of the finished ones and the recurrence of the last one."""

    def __init__(self, rules: Recurrence):
        self.rules, self.total, self.held = rules, 0, ""  # held: a contraction's beginning
        self._fresh()

    def _fresh(self) -> None:
        self.kind, self.tail, self.last, self.count, self.end = None, "", [-1], [0], 0

    def mark(self) -> tuple:
        return self.total, self.held, self.kind, self.tail, self.last, self.count, self.end, len(self.last)

    def reset(self, mark: tuple) -> None:
        self.total, self.held, self.kind, self.tail, self.last, self.count, self.end, size = mark
        del self.last[size:], self.count[size:]

    def close(self) -> None:
        self.total += self.end
        self._fresh()

    def feed(self, text: str) -> None:
        for c in text:
            both, self.held = self.held + c, ""
            if len(both) > 1:
                if both in CONTRACTIONS:
                    self.total += self.rules.ends(both)[-1]
                    continue
                if both in UNDECIDED:
                    self.held = both
                    continue
                for h in both[:-1]:
                    self._push(h)
            if c == "'" and self.kind != MARK:
                self.close()
                self.held = c
                continue
            self._push(c)

    def _push(self, c: str) -> None:
        symbols, kind = self.rules.character(c)
        if kind != self.kind or kind == NUMBER:
            self.close()
            self.kind = None if kind == SPACE else kind
        for s in symbols:
            self.tail = (self.tail + s)[-self.rules.longest :]
            last, count, self.end = self.rules.step(self.tail, self.last, self.count)
            self.last.append(last)
            self.count.append(count)

    def tokens(self) -> int:
        return self.total + self.end + sum(self.rules.ends(h)[-1] for h in self.held)


@lru_cache(maxsize=2)
def recurrence(file: str) -> Recurrence:
    """One a worker process, kept between tasks."""
    return Recurrence(file)


class PrefixStore(bpe.PieceStore):
    """For each distinct piece the counts of its beginnings, one a character; the last one is the piece's own."""

    def __init__(self, file: str, kept: int = bpe.KEPT_PIECES // 2):
        self.rules = recurrence(file)
        super().__init__(file, kept)

    def listed(self, pieces: list[str]) -> list[list[int]]:
        return [self.rules.table(p) for p in pieces]

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, count, which = self.lookup(data, starts, ends)
        return self.ids[first + count - 1][which].astype(np.int64)

    def beginnings(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tables of all pieces one after the other, last entry of each, length of each)."""
        inside, size = self.encode(data, starts, ends)
        return inside, inside[np.cumsum(size) - 1].astype(np.int64), size


@lru_cache(maxsize=2)
def store(file: str) -> PrefixStore:
    """One store a worker process, kept between tasks."""
    return PrefixStore(file)
