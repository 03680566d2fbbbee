"""A minimal acyclic transducer from words to ids, in one file that workers map.

Words that end alike share their states, as in a minimal automaton. A transition
carries the number of words that sort before those it leads to, so the numbers
along a path add up to the place of the word in the lexicon, and that place
leads to its ids. The file is a header and seven arrays of little-endian integers.
"""

from __future__ import annotations

import mmap
import struct
from array import array
from bisect import bisect_left
from collections.abc import Iterable
from functools import cached_property

import numpy as np

from .wordbpe import utf8

_MAGIC = b"WLEX0001"


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """The file for entries of different words, in any order."""
    rows = sorted((word.encode(), ids) for word, ids in entries)
    if any(a[0] == b[0] for a, b in zip(rows, rows[1:], strict=False)):
        raise ValueError("a word occurs twice")

    # A state is final or not, and has transitions by byte. States that nothing
    # can be added to any more are looked up among those seen, from the end back.
    final, arcs, seen = [False], [[]], {}

    def fold(path: list[int], depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            shape = (final[state], tuple(arcs[state]))
            kept = seen.setdefault(shape, state)
            if kept != state:
                label, _ = arcs[path[-1]][-1]
                arcs[path[-1]][-1] = (label, kept)

    path, last = [0], b""
    for word, _ in rows:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        fold(path, shared)
        for byte in word[shared:]:
            final.append(False)
            arcs.append([])
            arcs[path[-1]].append((byte, len(final) - 1))
            path.append(len(final) - 1)
        final[path[-1]] = True
        last = word
    fold(path, 0)

    # States that are left, children first, with the number of words below each.
    order, below, number = [], {}, {}
    todo = [(0, False)]
    while todo:
        state, done = todo.pop()
        if state in below and not done:
            continue
        if done:
            below[state] = int(final[state]) + sum(below[t] for _, t in arcs[state])
            number[state] = len(order)
            order.append(state)
        else:
            below[state] = 0
            todo.append((state, True))
            todo += [(t, False) for _, t in arcs[state] if t not in below]

    first, ends, labels, targets, outputs = array("i"), array("B"), array("B"), array("i"), array("i")
    for state in order:
        first.append(len(labels))
        ends.append(final[state])
        before = int(final[state])
        for byte, target in arcs[state]:
            labels.append(byte)
            targets.append(number[target])
            outputs.append(before)
            before += below[target]
    first.append(len(labels))
    offsets, ids = array("i", [0]), array("i")
    for _, own in rows:
        ids.extend(own)
        offsets.append(len(ids))
    parts = [first, ends, labels, targets, outputs, offsets, ids]
    head = _MAGIC + struct.pack("<i7q", number[0], *[len(p) for p in parts])
    return head.ljust(128, b"\0") + b"".join(p.tobytes().ljust(-(-len(p) * p.itemsize // 8) * 8, b"\0") for p in parts)


class Lexicon:
    """A compiled file, mapped into memory and read in place."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self._map)
        if bytes(view[:8]) != _MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        self.root, *sizes = struct.unpack_from("<i7q", view, 8)
        parts, at = [], 128
        for size, kind in zip(sizes, "iBBiiii", strict=True):
            width = struct.calcsize(kind) * size
            parts.append(view[at : at + width].cast(kind))
            at += -(-width // 8) * 8
        self.first, self.ends, self.labels, self.targets, self.outputs, self.offsets, self.ids = parts

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def states(self) -> int:
        return len(self.ends)

    def find(self, word: str) -> list[int] | None:
        """The word's ids, or None if the lexicon does not have it."""
        first, labels = self.first, self.labels
        state, place = self.root, 0
        for byte in word.encode():
            end = first[state + 1]
            arc = bisect_left(labels, byte, first[state], end)
            if arc == end or labels[arc] != byte:
                return None
            place += self.outputs[arc]
            state = self.targets[arc]
        if not self.ends[state]:
            return None
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tolist()

    @cached_property
    def _arcs(self) -> np.ndarray:
        """State and byte of each arc as one number; they ascend."""
        per_state = np.diff(np.asarray(self.first).astype(np.int64))
        return np.repeat(np.arange(len(per_state)), per_state) * 256 + np.asarray(self.labels)

    def find_all(self, words: list[str]) -> np.ndarray:
        """Each word's place among the words of the lexicon, -1 for those it does not have.

        All words go through the automaton in step, a byte at a time.
        """
        data, starts, sizes = utf8(words)
        arcs, outputs, targets = self._arcs, np.asarray(self.outputs), np.asarray(self.targets)
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        found = np.full(len(words), -1, np.int64)
        rows = np.arange(len(words))
        step = 0
        while len(rows):
            done = sizes[rows] == step
            ended = rows[done]
            ended = ended[np.asarray(self.ends)[state[ended]] > 0]
            found[ended] = place[ended]
            rows = rows[~done]
            if not len(rows) or not len(arcs):
                break
            wanted = state[rows] * 256 + data[starts[rows] + step]
            arc = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            there = arcs[arc] == wanted
            rows, arc = rows[there], arc[there]
            place[rows] += outputs[arc]
            state[rows] = targets[arc]
            step += 1
        return found
