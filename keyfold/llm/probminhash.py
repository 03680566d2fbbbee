"""ProbMinHash signatures of weighted shingles, for many documents at a time.

Each shingle arrives at the registers in a Poisson process whose rate is its
weight: the gaps between its arrivals are exponential, the register of each is
uniform, and both follow from a hash of the shingle alone. A register keeps its
first arrival. A shingle is done once its next arrival is later than the last of
its document's registers. Two documents agree in a register with the probability
Jaccard similarity of their weights.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

from .wordbpe import Memo

WIDTH = 5
REGISTERS = 288
# Bands are cut from the first registers; marks are made of all.
BANDS, ROWS = 24, 6
# Words of more characters are long.
SHORT = 3
# Words whose hashes a worker keeps, once or twice over.
KEPT_WORDS = 50_000
# Fewer shingles than this reach a similarity of 0.8 only with an equal set.
FEWEST = 4

_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0x100000001B3 * 0x10001 + 2)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of word shingles; the hashes of words are kept in bounded memory."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.words = Memo(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")), KEPT_WORDS)

    def shingles(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes in ascending order, and how many long words each has.

        Words are runs of letters and digits in lower case. A text with fewer words
        than a shingle has is one shingle; without words it has none.
        """
        words = _WORD.findall((text or "").lower())
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        joined = hashes[:n].copy()
        for i in range(1, width):
            joined = joined * _FACTOR + hashes[i : i + n]
        long = np.cumsum([0, *[len(word) > SHORT for word in words]])
        distinct, first = np.unique(mix(joined), return_index=True)
        return distinct, (long[width:] - long[:-width])[first]


def weigh(long_words: np.ndarray) -> np.ndarray:
    """The weight of shingles of so many long words: from 1 to 9/8 for five.

    A shingle weighs the same in every document. Short words are mostly those of
    grammar, and shingles of them tell less. With weights between 1 and 9/8 the
    probability Jaccard similarity of sets at a plain one of 0.8 is 0.78 at least.
    """
    return 1.0 + long_words / (8.0 * WIDTH)


def signatures(shingles: list[np.ndarray], weights: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """One row of ``registers`` shingle hashes a document; no document may be without shingles."""
    sizes = np.array([len(s) for s in shingles])
    doc = np.repeat(np.arange(len(shingles)), sizes)
    hashes, rate = np.concatenate(shingles), 1.0 / np.concatenate(weights)
    first = np.full(len(shingles) * registers, np.inf)
    holder = np.zeros(len(first), np.uint64)
    time = np.zeros(len(hashes))
    state = hashes.copy()
    while len(hashes):
        state = state + _STEP
        draw = mix(state)
        time = time - np.log((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) * rate
        place = doc * registers + (mix(draw ^ _STEP) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        holder[place[won]] = hashes[won]
        last = first.reshape(-1, registers).max(axis=1)
        going = time < last[doc]
        doc, hashes, rate, time, state = doc[going], hashes[going], rate[going], time[going], state[going]
    return holder.reshape(-1, registers)


def marks(signature: np.ndarray) -> np.ndarray:
    """Four bits of each register, sixteen registers a number: a small copy to estimate with."""
    docs, registers = signature.shape
    bits = (mix(signature) & np.uint64(15)).reshape(docs, registers // 16, 16)
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    return (bits << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash a band of registers, as signed integers; equal rows have equal keys."""
    docs = len(signature)
    parts = signature[:, : bands * ROWS].reshape(docs, bands, ROWS)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (docs, bands)).copy()
    for i in range(parts.shape[2]):
        keys = mix(keys * _FACTOR + parts[:, :, i])
    return keys.view(np.int64)
