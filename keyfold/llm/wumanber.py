"""Wu-Manber search for many test strings at once, over words.

A symbol is a word and a block two words that stand side by side. For each block
of a test string the shift table has how far its last place is from the string's
end; a block that no test string has lets the search go on by all the words that
are left. A shift of nothing leads to the bucket of strings that end with this
block, of which those with the same beginning (its hash) are compared word by
word, byte by byte. Strings of each number of words have tables of their own, so
a short one does not shorten the steps of the others.

Texts are cut into lanes that step side by side, so all work is on whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# What a byte counts as: nothing for a separator, lower case for A to Z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x00:0x30] = FOLD[0x3A:0x41] = FOLD[0x5B:0x61] = FOLD[0x7B:0x80] = 0
FOLD[0x41:0x5B] += 0x20

_LANE = 256
# Bytes hashed or compared in one step.
_SLICE = 1 << 22
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_MASK = (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _K3
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of texts that lie one after the other in ``data``.

    Word ``i`` is ``folded[starts[i]:ends[i]]``; text ``t`` has the words from
    ``first[t]`` up to ``first[t + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.folded = FOLD[data]
        inside = self.folded != 0
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        # A word ends with its text.
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, i: int) -> bytes:
        return self.folded[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self, seed: int) -> np.ndarray:
        """A number for each word, the same for equal words."""
        base = (2 * seed + 0x5851F42D4C957F2D) | 1
        out = np.empty(len(self), np.uint64)
        widths = (self.ends - self.starts).astype(np.uint64)
        at = 0
        while at < len(self):
            begin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, begin + _SLICE, side="right")))
            size = int(self.ends[to - 1] - begin)
            up, down = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
            places = self.starts[at:to] - begin
            # Separators are nothing, so a sum may run up to the next word.
            sums = np.add.reduceat(self.folded[begin : begin + size].astype(np.uint64) * up, places)
            out[at:to] = sums * down[places]
            at = to
        return _mix(out + widths * _K1)


_kept: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """The first powers of a number modulo 2^64; those of one slice are kept."""
    known = _kept.get(base)
    if known is not None and len(known) >= size:
        return known[:size]
    steps = np.full(max(size, 1 << 16), base & _MASK, np.uint64)
    steps[0] = 1
    powers = np.cumprod(steps)
    if size <= _SLICE:
        if len(_kept) > 7:
            _kept.clear()
        _kept[base] = powers
    return powers[:size]


def _block(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * _K2 + second)


class _Length:
    """The tables for test strings of one number of words."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, numbers: np.ndarray):
        self.m = ids.shape[1]
        self.block = min(2, self.m)
        self.most = self.m - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(8 * hashes.shape[0] * self.most + 1)), 12, 24))
        self.shift = np.full(1 << self.bits, min(self.most, 255), np.uint8)
        for end in range(self.block, self.m + 1):
            # Blocks that share a slot get the smallest of their shifts.
            np.minimum.at(self.shift, self._slot(self._block_at(hashes, end - 1)), min(self.m - end, 255))
        keys = self._keys(hashes, np.full(len(hashes), self.m - 1))
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids, self.numbers = keys[order], ids[order], numbers[order]

    def _block_at(self, rows: np.ndarray, last: int) -> np.ndarray:
        return _mix(rows[:, last]) if self.block == 1 else _block(rows[:, last - 1], rows[:, last])

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def blocks(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix(hashes[ends]) if self.block == 1 else _block(hashes[ends - 1], hashes[ends])

    def _keys(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bucket of the last block above the hash of the words before it."""
        flat, at = rows.reshape(-1), np.arange(len(rows)) * rows.shape[1] + ends
        return self.bucket_keys(flat, at)

    def bucket_keys(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        beginning = np.zeros(len(ends), np.uint64)
        for back in range(self.m - 1, self.block - 1, -1):
            beginning = _block(beginning, hashes[ends - back])
        slot = self._slot(self.blocks(hashes, ends)).astype(np.uint64)
        return (slot << np.uint64(64 - self.bits)) | (beginning >> np.uint64(self.bits))

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places of last words at which the shift is nothing."""
        begin, stop = first[:-1] + self.m - 1, first[1:]
        lanes = np.maximum(0, -(-(stop - begin) // _LANE))
        text = np.repeat(np.arange(len(lanes)), lanes)
        step = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        place = begin[text] + step * _LANE
        stop = np.minimum(place + _LANE, stop[text])
        found = []
        while len(place):
            shift = self.shift[self._slot(self.blocks(hashes, place))]
            here = shift == 0
            if here.any():
                found.append(place[here])
            place = place + np.maximum(shift, 1)
            going = place < stop
            place, stop = place[going], stop[going]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)


class Patterns:
    """Test strings, each a sequence of words, compiled for ``search``.

    ``owners[i]`` belongs to string ``i``; strings of a word each are in lower case.
    """

    def __init__(self, strings: Sequence[bytes]):
        """``strings`` are different, their words parted by one space."""
        data = np.frombuffer(b" ".join(strings), np.uint8)
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        words = Words(data, np.concatenate([[0], np.cumsum(sizes)]))
        spelled = sorted({words[i] for i in range(len(words))})
        for self.seed in range(64):
            known = Words(*_side_by_side(spelled)).hashes(self.seed)
            if len(np.unique(known)) == len(known):
                break
        else:
            raise ValueError("different words keep having the same hash")
        order = np.argsort(known)
        self.known = known[order]
        self.text, self.places = _side_by_side([spelled[i] for i in order])
        hashes = words.hashes(self.seed)
        ids = np.searchsorted(self.known, hashes)
        counts = np.diff(words.first)
        self.lengths = []
        for m in np.unique(counts[counts > 0]):
            numbers = np.flatnonzero(counts == m)
            at = words.first[numbers][:, None] + np.arange(m)
            self.lengths.append(_Length(hashes[at], ids[at], numbers))

    def _identify(self, words: Words, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The number of each word at the given places among the known ones, -1 for others."""
        guess = np.minimum(np.searchsorted(self.known, hashes[at]), max(0, len(self.known) - 1))
        widths = words.ends[at] - words.starts[at]
        begin = self.places[guess]
        same = (self.known[guess] == hashes[at]) & (self.places[guess + 1] - begin - 1 == widths)
        out, todo = np.full(len(at), -1), np.flatnonzero(same)
        ends = np.cumsum(widths[todo])
        start = 0
        while start < len(todo):
            done = ends[start - 1] if start else 0
            to = max(start + 1, int(np.searchsorted(ends, done + _SLICE, side="right")))
            part = todo[start:to]
            sizes = widths[part]
            heads = np.cumsum(sizes) - sizes
            inner = np.arange(sizes.sum()) - np.repeat(heads, sizes)
            theirs = words.folded[np.repeat(words.starts[at[part]], sizes) + inner]
            ours = self.text[np.repeat(begin[part], sizes) + inner]
            equal = np.logical_and.reduceat(theirs == ours, heads)
            out[part[equal]] = guess[part[equal]]
            start = to
        return out

    def search(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of words, places of the first word and numbers of the strings that occur."""
        if not len(self.known) or not len(words):
            return
        hashes = words.hashes(self.seed)
        for tables in self.lengths:
            ends = tables.candidates(hashes, words.first)
            keys = tables.bucket_keys(hashes, ends)
            low, high = (np.searchsorted(tables.keys, keys, side=s) for s in ("left", "right"))
            ends, low, high = (x[high > low] for x in (ends, low, high))
            if not len(ends):
                continue
            window = ends[:, None] - np.arange(tables.m - 1, -1, -1)
            at, where = np.unique(window, return_inverse=True)
            ids = self._identify(words, hashes, at)[where].reshape(window.shape)
            # Different strings of one bucket and one hash of the beginning are next to none.
            while len(ends):
                equal = (tables.ids[low] == ids).all(axis=1)
                if equal.any():
                    yield tables.m, ends[equal] - tables.m + 1, tables.numbers[low[equal]]
                low = low + 1
                more = low < high
                ends, low, high, ids = ends[more], low[more], high[more], ids[more]


def _side_by_side(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words, each followed by a space, and where they start, with the end last."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    joined = b"".join(w + b" " for w in words)
    return np.frombuffer(joined, np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
