"""A word-level BPE vocabulary: how texts fall into words, and words into tokens.

The vocabulary comes from a public tokenizer file whose path is a parameter; each
Python worker reads it once. Words are cut as the file's normaliser and pattern
say: NFC, lower case, then contractions, runs of letters, single digits and runs
of anything else. The last symbol of a word carries the end mark.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex

END = "</w>"
_SHORT = (2, 1)
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
# Python counts these four as white space, Unicode does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(printable))
    return [symbols[b] for b in range(256)]


class WordBpe:
    """Ids of words by exact merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.texts[i] = text
        # Tokens are numbered in the order of their merges, so a number is a rank as well.
        self.joined: dict[tuple[int, int], int] = {(vocab[a], vocab[b]): vocab[a + b] for a, b in spec["model"]["merges"]}
        self.halves = {token: pair for pair, token in self.joined.items()}
        if list(self.halves) != sorted(self.halves) or len(self.halves) < len(self.joined):
            raise ValueError("tokens must be numbered in the order of their merges")
        symbols = _byte_symbols()
        self.byte_text = symbols
        self.open_ids = [vocab[s] for s in symbols]
        self.closed_ids = [vocab[s + END] for s in symbols]
        self.open = {text: i for text, i in vocab.items() if not text.endswith(END)}
        self.closed = {text.removesuffix(END): i for text, i in vocab.items() if text.endswith(END)}
        self.longest = max(map(len, [*self.open, *self.closed]))
        # How long tokens are by the three symbols that they start with, the longest first.
        sizes: dict[str, set[int]] = {}
        for text in self.open:
            if len(text) > 2:
                sizes.setdefault(text[:3], {1, 2}).add(len(text))
        self.sizes = {start: tuple(sorted(found, reverse=True)) for start, found in sizes.items()}
        self.fits = Memo(self._fits, 100_000)
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special strings, normalised, and the special strings with their id."""
        at = 0
        if self._special and "<|" in text:
            for found in self._special.finditer(text):
                yield normalise(text[at : found.start()]), None
                yield found[0], self.special[found[0]]
                at = found.end()
        yield normalise(text[at:] if at else text), None

    def symbols(self, piece: str) -> list[int]:
        data = piece.encode()
        ids = [self.open_ids[b] for b in data]
        ids[-1] = self.closed_ids[data[-1]]
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """Join the pair of the lowest rank, the leftmost first, until none is left."""
        if len(ids) > 48:
            return self._merge_long(ids)
        ranks = self.joined
        while len(ids) > 1:
            best, where = 1 << 60, None
            for pair in zip(ids, ids[1:]):
                rank = ranks.get(pair, best)
                if rank < best:
                    best, where = rank, pair
            if where is None:
                return ids
            first, second = where
            new, out, i, last = best, [], 0, len(ids) - 1
            while i <= last:
                if i < last and ids[i] == first and ids[i + 1] == second:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list, for words of any length."""
        ids, n = list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.joined.get((ids[i], ids[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.joined[a, b], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (r := self.joined.get((ids[left], ids[right]))) is not None:
                    heappush(heap, (r, left, ids[left], ids[right]))
        return [t for t in ids if t >= 0]

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether the two tokens side by side encode to themselves.

        Merges are undone from the latest back. The pair fails if, at some point,
        the two tokens at the border would have been joined before what stands
        there now. With -1 first: whether the second alone encodes to itself.
        """
        first, second = pair
        if first < 0:
            return self._alone(second)
        joined, halves = self.joined, self.halves
        # Merged tokens are numbered in the order of their merges, after all symbols.
        bound = 1 << 60
        while True:
            if joined.get((first, second), bound) < bound:
                return False
            if second not in halves or (first > second and first in halves):
                if first not in halves:
                    return True
                bound, first = first, halves[first][1]
            else:
                bound, second = second + 1, halves[second][0]

    def _alone(self, token: int) -> bool:
        symbols, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.halves:
                a, b = self.halves[t]
                todo += [b, a]
            else:
                symbols.append(t)
        return self.merge(symbols) == [token]

    def spell(self, piece: str) -> str:
        """The piece in the characters that stand for its bytes."""
        return "".join(map(self.byte_text.__getitem__, piece.encode()))

    def merged(self, piece: str) -> list[int]:
        """What ``merge`` makes of the piece, without going through all merges.

        There is one way to cut a word so that no merge would change any two
        neighbours, and that is the merged one. It is looked for with the longest
        token first; a place from which no way leads to the end is not tried twice.
        """
        text = self.spell(piece)
        opened, closed, fits, sizes, longest, n = self.open, self.closed, self.fits, self.sizes, self.longest, len(text)
        out: list[int] = []
        at, before, dead = [0], -1, set()
        start, fresh, most = 0, True, n - 1
        while True:
            if fresh and n - start <= longest:
                token = closed.get(text[start:])
                if token is not None and fits[before, token]:
                    out.append(token)
                    return out
            fresh = False
            for size in sizes.get(text[start : start + 3], _SHORT):
                if size > most:
                    continue
                end = start + size
                token = opened.get(text[start:end])
                if token is not None and end not in dead and fits[before, token]:
                    out.append(token)
                    at.append(end)
                    start, before, fresh, most = end, token, True, n - end - 1
                    break
            if not fresh:
                dead.add(at.pop())
                most = start - at[-1] - 1
                start = at[-1]
                out.pop()
                before = out[-1] if out else -1

    def encode_word(self, word: str, of_piece: Callable[[str], list[int]] | None = None) -> list[int]:
        """Ids of a normalised stretch of text without white space."""
        of_piece = of_piece or self.merged
        parts = pieces(word)
        return of_piece(parts[0]) if len(parts) == 1 else [i for p in parts for i in of_piece(p)]

    def decode(self, ids) -> str:
        """The texts of the tokens with one space between; the file names no decoder."""
        return " ".join(map(self.texts.__getitem__, ids))


def normalise(text: str) -> str:
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    # Letter by letter, so that a final sigma stays an ordinary one.
    return text.replace("Σ", "σ").lower()


def words(segment: str) -> list[str]:
    """The stretches between white space. No token reaches over white space."""
    if _SEPARATORS.search(segment):
        return [w for w in _SPACES.split(segment) if w]
    return segment.split()


def word_starts(segment: str) -> Iterator[tuple[int, str]]:
    at = 0
    for gap in _SPACES.finditer(segment):
        if gap.start() > at:
            yield at, segment[at : gap.start()]
        at = gap.end()
    if at < len(segment):
        yield at, segment[at:]


def pieces(word: str) -> list[str]:
    if word.isalpha() and word.isascii():
        return [word]
    return _PIECES.findall(word)


@lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    """Once per Python worker."""
    return WordBpe(path)


def utf8(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts and how long it is."""
    if not texts:
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    _, offsets, data = pa.array(texts, pa.large_string()).buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), ends[:-1], np.diff(ends)


class Merger:
    """Merges many pieces in step: in each round every piece joins its pair of the lowest rank."""

    # Longer pieces are merged one by one, with a heap.
    LONGEST = 48
    # Pieces that go in step, what bounds memory.
    ROWS = 1 << 15

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.radix = len(bpe.texts)
        keys = np.array([a * self.radix + b for a, b in bpe.joined], np.int64)
        order = np.argsort(keys)
        self.keys, self.tokens = keys[order], np.array(list(bpe.joined.values()), np.int64)[order]
        self.none = self.radix
        self.open_ids, self.closed_ids = np.array(bpe.open_ids, np.int64), np.array(bpe.closed_ids, np.int64)

    def _ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The token, which is a rank as well, that two tokens join to; above all tokens for none."""
        wanted = first * self.radix + second
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (first >= 0) & (second >= 0), self.tokens[at], self.none)

    def _in_step(self, ids: np.ndarray) -> np.ndarray:
        """Rows of tokens, -1 behind the last, merged in place of each other; shorter rows end in -1."""
        out = np.full(ids.shape, -1, np.int64)
        rows, ranks = np.arange(len(ids)), self._ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            width = ids.shape[1]
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
            lowest = ranks[np.arange(len(rows)), at] if width > 1 else np.full(len(rows), self.none)
            more = lowest < self.none
            out[rows[~more], :width] = ids[~more]
            rows, ids, ranks, at, lowest = rows[more], ids[more], ranks[more], at[more], lowest[more]
            if not len(rows):
                break
            # What stands behind the pair moves up by one.
            row, behind = np.arange(len(rows)), np.arange(width - 1) > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[row, at] = lowest
            ranks = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            left, right = at > 0, at < width - 2
            ranks[row[left], at[left] - 1] = self._ranks(ids[row[left], at[left] - 1], lowest[left])
            ranks[row[right], at[right]] = self._ranks(lowest[right], ids[row[right], at[right] + 1])
        return out

    def merge(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        data, starts, sizes = utf8(found)
        counts = np.zeros(len(found), np.int64)
        parts: list[np.ndarray] = []
        order = np.argsort(sizes, kind="stable")
        short = int((sizes <= self.LONGEST).sum())
        for begin in range(0, short, self.ROWS):
            chosen = order[begin : min(begin + self.ROWS, short)]
            width = np.arange(sizes[chosen[-1]])
            inside = width < sizes[chosen][:, None]
            symbols = np.where(inside, data[np.where(inside, starts[chosen][:, None] + width, 0)], 0)
            last = width == sizes[chosen][:, None] - 1
            merged = self._in_step(np.where(inside, np.where(last, self.closed_ids[symbols], self.open_ids[symbols]), -1))
            counts[chosen] = (merged >= 0).sum(axis=1)
            parts.append(merged[merged >= 0])
        for i in order[short:].tolist():
            merged = self.bpe.merge(self.bpe.symbols(found[i]))
            counts[i] = len(merged)
            parts.append(np.array(merged, np.int64))
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        # Back from the order of sizes to the given one.
        begins = np.empty(len(found), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return flat[np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(len(flat))].astype(np.int32), counts


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(model(path))


class Memo(dict):
    """Results by word. Once full, only what was asked for lately is kept, so it stays bounded."""

    def __init__(self, compute, size: int = 150_000):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}
