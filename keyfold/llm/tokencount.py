"""Token counts from a table of the exact count at every prefix.

For each prefix of a word the last token of its encoding is unique: the one that
ends there and is compatible with the last token of the prefix before it, that
is, the two side by side encode to themselves. So one pass from left to right
finds the number of tokens of every prefix from those of shorter ones. A text's
counts add up word by word, which answers how many tokens a prefix has and where
a text must be cut for a budget, without encoding anything again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from .wordbpe import Memo, WordBpe, model, pieces, word_starts, words

BATCH_CHARS = 4 << 20
COUNTED = StructType(
    [
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
        StructField("limit_chars", LongType()),
        StructField("prefix_tokens", ArrayType(IntegerType())),
    ]
)


class PrefixCounter:
    """Counts of words, with tables that are kept for words seen before."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.open, self.closed, self.pairs, self.longest = bpe.open, bpe.closed, bpe.fits, bpe.longest
        self.piece = Memo(self._count_piece)
        self.count = Memo(self._count)

    def _step(self, text: str, end: int, tokens: dict[str, int], last: list[int], counts: list[int]) -> tuple[int, int]:
        """Last token and count of the prefix that ends at ``end``."""
        fits = self.pairs
        for start in range(max(0, end - self.longest), end):
            token = tokens.get(text[start:end])
            if token is not None and fits[last[start], token]:
                return token, counts[start] + 1
        raise AssertionError("a single symbol always is a token")

    def open_table(self, text: str) -> tuple[list[int], list[int]]:
        """Last tokens and counts of all prefixes as beginnings of a longer word."""
        last, counts = [-1], [0]
        for end in range(1, len(text)):
            token, n = self._step(text, end, self.open, last, counts)
            last.append(token)
            counts.append(n)
        return last, counts

    def piece_prefixes(self, piece: str) -> list[int]:
        """The count of ``piece[:i]`` as a text of its own, for every i from 0."""
        counts_at, at = [0], 0
        text = self.bpe.spell(piece)
        table = self.open_table(text)
        for char in piece:
            at += len(char.encode())
            counts_at.append(self._step(text, at, self.closed, *table)[1])
        return counts_at

    def _count_piece(self, piece: str) -> int:
        text = self.bpe.spell(piece)
        if text in self.closed and self.pairs[-1, self.closed[text]]:
            return 1
        return self._step(text, len(text), self.closed, *self.open_table(text))[1]

    def _count(self, word: str) -> int:
        return sum(map(self.piece.__getitem__, pieces(word)))

    def total(self, text: str) -> int:
        n = 0
        for segment, special in self.bpe.segments(text):
            n += 1 if special is not None else sum(map(self.count.__getitem__, words(segment)))
        return n

    def word_prefixes(self, word: str) -> list[int]:
        """The count of every prefix of a stretch without white space."""
        counts, done = [0], 0
        for part in pieces(word):
            own = self.piece_prefixes(part)
            if part[0] == "'" and part[1:].isalpha():
                # A cut contraction falls into an apostrophe and letters.
                own[1:-1] = [self.count[part[:i]] for i in range(1, len(part))]
            counts += [done + n for n in own[1:]]
            done += own[-1]
        return counts

    def prefixes(self, text: str) -> list[int]:
        """The count of every prefix of the normalised text, by code point, from the empty one."""
        counts, done, before, word = [0], 0, 0, ""
        for segment, special in self.bpe.segments(text):
            if special is not None:
                # Until it is complete, a special string continues the word before it.
                counts += [before + self.count[word + segment[:i]] for i in range(1, len(segment))]
                done += 1
                counts.append(done)
                before, word = done, ""
                continue
            at = 0
            for start, word in word_starts(segment):
                counts += [done] * (start - at)
                own = self.word_prefixes(word)
                counts += [done + n for n in own[1:]]
                before, done, at = done, done + own[-1], start + len(word)
            if at < len(segment):
                counts += [done] * (len(segment) - at)
                before, word = done, ""
        return counts

    def length(self, text: str) -> int:
        """Code points of the normalised text."""
        return len(text) if text.isascii() else sum(len(segment) for segment, _ in self.bpe.segments(text))

    def cut(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of the normalised text with at most ``limit`` tokens."""
        done = at = 0
        for segment, special in self.bpe.segments(text):
            if special is not None:
                if done + 1 > limit:
                    return at
                done, at = done + 1, at + len(segment)
                continue
            for start, word in word_starts(segment):
                n = self.count[word]
                if done + n > limit:
                    own = self.word_prefixes(word)
                    return at + start + max(i for i, c in enumerate(own) if done + c <= limit)
                done += n
            at += len(segment)
        return at


@lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(model(path))


def batches_of(texts: pa.Array, chars: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about so many bytes of text, at least one row each."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def token_counts(
    docs: DataFrame, path: str, limit: int, keep: Sequence[str] | None = None, text: str = "text", prefixes: bool = False
) -> DataFrame:
    """``docs`` with ``n_bytes, n_tokens, over_limit, limit_chars`` and, if asked for, ``prefix_tokens``.

    ``limit_chars`` is the length of the longest beginning of the normalised text
    that has at most ``limit`` tokens; ``prefix_tokens[i]`` is the count of its
    first i code points. The tokenizer file at ``path`` must be there on every
    worker. Null text counts as empty: no bytes, no tokens. Whole texts are
    counted, however long. ``keep`` names the columns to return, all unless given;
    columns of the new names are replaced. Repeated rows are counted each.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in COUNTED.names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("text"))
    schema = rows.select("doc").schema
    schema = StructType([*schema, *[f for f in COUNTED if prefixes or f.name != "prefix_tokens"]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for start, end in batches_of(batch.column("text")):
                part = batch.slice(start, end - start)
                texts = [t or "" for t in part.column("text").to_pylist()]
                totals = [counter.total(t) for t in texts]
                within = [counter.cut(t, limit) if n > limit else counter.length(t) for t, n in zip(texts, totals, strict=True)]
                columns = [
                    part.column("doc"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                    pa.array(within, pa.int64()),
                ]
                if prefixes:
                    columns.append(pa.array([counter.prefixes(t) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(count, schema).select("doc.*", *schema.names[1:])
