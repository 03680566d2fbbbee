"""Cross-entropy difference of two matched bigram models.

A model of the target documents and one of all documents share one vocabulary:
every word of the corpus, and one class for words it does not have. Both are
smoothed alike, and the background's counts are scaled to the size of the
target's, so that they differ by what was counted and not by how much. The score
of a document is the mean, over its tokens, of the target model's loss minus the
background model's; the lower, the more it is like the target.

Counts come from all documents and grow with them: those of pairs, of words and
of words that something follows are cells, which fall into blocks by the first
bits of their keys and are never collected. Documents are read in chunks. A chunk
sends each block its cells and their counts; the block adds up those of all
chunks and sends each chunk the sums of the cells that it sent (`score_corpus`).
To score other documents, the sums are stored, and chunks ask for their cells
(`fit_models`, `score_documents`). A cell has a hash of 64 bits as its key; two of
five billion cells share one with a probability of about one half.

Up to 64 GB of text there are at most 4,096 blocks, so messages grow with the
chunks alone; beyond that with the blocks as well, since a block has to fit into
a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from ..storage import store
from .common import join_measured
from .probminhash import mix
from .tokencount import batches_of
from .wordbpe import Memo

# Counts that the unigrams lend to the words after each word, and each word to the unigrams.
PRIOR, START = 20.0, 0.5
# Text, and documents, of a chunk.
CHUNK_CHARS, CHUNK_DOCS = 8 << 20, 100_000
# Text that a block of cells stands for: the smaller figure up to so many blocks, then up to the larger.
BLOCK_CHARS, LARGEST_BLOCK_CHARS = 1 << 20, 16 << 20
LEAST_BLOCK_BITS, LINEAR_BLOCK_BITS = 6, 12

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
# The hash that stands before a document's first word.
_BEFORE = np.uint64(0)
_FACTOR, _WORD_SALT, _CONTEXT_SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)
_ODD = np.uint64(1)


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case, and single other characters."""
    return _TOKEN.findall((text or "").lower())


def _pack(values: np.ndarray) -> bytes:
    """Numbers byte by byte of their places, compressed."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(packed[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


def _join(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _hash(word: str) -> int:
    # Zero stands before the first word.
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) or 1


@dataclass
class _Chunk:
    """The words of some documents: hashes of the different ones, and by token which it is."""

    hashes: np.ndarray
    codes: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> _Chunk:
        hashes, codes = np.unique(_join(texts, np.uint64), return_inverse=True)
        return cls(hashes, codes.astype(np.int64), np.array([len(t) for t in texts], np.int64))

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of its pairs, then its words, then what stands before them; by token its pair and the word before; the pairs."""
        words = len(self.hashes)
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = words
        pairs, pair_of = np.unique(before * (words + 1) + self.codes, return_inverse=True)
        contexts = np.append(self.hashes, _BEFORE)
        first, second = contexts[pairs // (words + 1)], contexts[pairs % (words + 1)]
        # The last bit tells words from the rest.
        keys = [mix(first * _FACTOR + second) & ~_ODD, mix(self.hashes ^ _WORD_SALT) | _ODD, mix(contexts ^ _CONTEXT_SALT) & ~_ODD]
        return np.concatenate(keys), pair_of, before, pairs, contexts

    def counts(self, chosen: slice | np.ndarray, pair_of: np.ndarray, before: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """How often each cell occurs among the chosen tokens."""
        places = ((pair_of[chosen], len(pairs)), (self.codes[chosen], len(self.hashes)), (before[chosen], len(self.hashes) + 1))
        return np.concatenate([np.bincount(p, minlength=n) for p, n in places]).astype(np.int64)


def _in_order(keys: np.ndarray, before: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Places of the cells by their keys, but for words that nothing follows here."""
    used = np.ones(len(keys), bool)
    used[len(keys) - len(contexts) :] = np.bincount(before, minlength=len(contexts)) > 0
    order = np.argsort(keys)
    return order[used[order]]


def _encoded(batches: Iterator[pa.RecordBatch], extra: str) -> Iterator[tuple[list[np.ndarray], list[pa.Array]]]:
    """Hashes of the tokens of the documents of each chunk, and their column ``extra``."""
    memo = Memo(_hash)
    texts: list[np.ndarray] = []
    others: list[pa.Array] = []
    chars = 0
    for batch in batches:
        for start, end in batches_of(batch.column("text")):
            part = batch.slice(start, end - start)
            for at in range(0, len(part), CHUNK_DOCS):
                piece = part.slice(at, CHUNK_DOCS)
                for t in piece.column("text").to_pylist():
                    found = tokens(t)
                    chars += len(t or "")
                    texts.append(np.fromiter(map(memo.__getitem__, found), np.uint64, len(found)))
                others.append(piece.column(extra))
                if chars >= CHUNK_CHARS or len(texts) >= CHUNK_DOCS:
                    yield texts, others
                    texts, others, chars = [], [], 0
    if texts:
        yield texts, others


def _by_block(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The blocks of sorted keys, and where they lie."""
    blocks = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(blocks, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
        yield int(blocks[start]), slice(start, end)


def _chars(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.length(F.col(text))), F.lit(0))).first()[0]


def block_bits(chars: int) -> int:
    """How many first bits of a key name its block, for so much text."""
    bits = max(LEAST_BLOCK_BITS, (chars // BLOCK_CHARS).bit_length())
    return min(bits, max(LINEAR_BLOCK_BITS, (chars // LARGEST_BLOCK_CHARS).bit_length()))


def _messages(chunk: _Chunk, wanted: np.ndarray, bits: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """Block, keys, and how often they occur in all and in target documents; ``wanted`` tells a token's document."""
    keys, pair_of, before, pairs, contexts = chunk.cells()
    order = _in_order(keys, before, contexts)
    keys = keys[order]
    n, n_target = (chunk.counts(chosen, pair_of, before, pairs)[order] for chosen in (slice(None), wanted))
    return [(b, _pack_keys(keys[at]), _pack(n[at]), _pack(n_target[at])) for b, at in _by_block(keys, bits)]


def cell_counts(docs: DataFrame, bits: int) -> DataFrame:
    """``block, keys, n, n_target, words, pairs, pairs_target`` over ``text, target``.

    One row a block of cells: their keys in order, how often each occurs in all and
    in target documents, packed; how many of them are words, and those' sums.
    """
    packed = [StructField("block", LongType()), *[StructField(n, BinaryType()) for n in ("keys", "n", "n_target")]]
    partial = StructType(packed)
    whole = StructType([*packed, *[StructField(n, LongType()) for n in ("words", "pairs", "pairs_target")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, targets in _encoded(batches, "target"):
            chunk = _Chunk.of(texts)
            wanted = np.repeat(np.array(pa.chunked_array(targets).to_pylist(), bool), chunk.sizes)
            rows = _messages(chunk, wanted, bits)
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=partial.names)

    def merge(part: pa.Table) -> pa.Table:
        keys = np.concatenate([_unpack_keys(k) for k in part.column("keys").to_pylist()])
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        sums = []
        for name in ("n", "n_target"):
            counts = np.concatenate([_unpack(c, np.int64) for c in part.column(name).to_pylist()])
            sums.append(np.add.reduceat(counts[order], starts))
        keys = keys[starts]
        words = (keys & _ODD).astype(bool)
        row = [part.column("block")[0].as_py(), _pack_keys(keys), *map(_pack, sums), int(words.sum()), *[int(s[words].sum()) for s in sums]]
        kinds = [pa.int64(), *[pa.binary()] * 3, *[pa.int64()] * 3]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=whole.names)

    return docs.select("text", "target").mapInArrow(count, partial).groupBy("block").applyInArrow(merge, whole)


@dataclass(frozen=True)
class PairModel:
    """Counts of cells in blocks, and their sums: pairs in target and in all documents, words."""

    cells: DataFrame | None
    bits: int
    pairs: int
    pairs_target: int
    n_words: int

    def loss(self, pair: np.ndarray, word: np.ndarray, context: np.ndarray, total: float) -> np.ndarray:
        """Minus the log of the smoothed probability of a word after another, from their counts and the sum of all."""
        single = (word + START) / (total + START * (self.n_words + 1))
        return -np.log((pair + PRIOR * single) / (context + PRIOR))


def _marked(texts: DataFrame, target: DataFrame, doc_id: str) -> DataFrame:
    """``texts`` with ``target``: whether the id is one of ``target``."""
    ids = store(target.select(F.col(doc_id).alias("id"), F.lit(True).alias("target")).dropna().distinct(), "target")
    return join_measured(texts, ids, "id", "left", 64).withColumn("target", F.coalesce("target", F.lit(False)))


def fit_models(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text") -> PairModel:
    """Models of the documents whose id is in ``target`` and of all documents.

    Without any target document both models are the same. One row of sums reaches
    the driver; the table of cells is stored.
    """
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    marked = _marked(texts, target, doc_id).select("text", "target")
    bits = block_bits(_chars(docs, text))
    cells = store(cell_counts(marked, bits), "cells")
    sums = cells.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in ("pairs", "pairs_target", "words")]).first()
    return PairModel(cells.select("block", "keys", "n", "n_target"), bits, *sums)


_MADE = ("n_tokens", "loss_target", "loss_background", "score")
_PACKED = ("hashes", "codes", "sizes")
_TOLD = StructType([StructField("chunk", LongType()), StructField("block", LongType()), *[StructField(n, BinaryType()) for n in ("n", "n_target")]])


def _rows(docs: DataFrame, keep: Sequence[str] | None, *others: Column) -> DataFrame:
    kept = [c for c in (docs.columns if keep is None else keep) if c not in _MADE]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), *others)


def _chunked(rows: DataFrame) -> DataFrame:
    """``chunk, hashes, codes, sizes, wanted, n, n_target, docs`` over ``doc, text, target``, stored.

    ``wanted`` tells which documents are in the target; ``n`` and ``n_target`` count
    tokens. Each task numbers its chunks; they are stored, so the numbers stay.
    """
    doc = rows.schema["doc"].dataType
    fields = [StructField("chunk", LongType()), *[StructField(n, BinaryType()) for n in (*_PACKED, "wanted")]]
    whole = StructType([*fields, *[StructField(n, LongType()) for n in ("n", "n_target")], StructField("docs", ArrayType(doc))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for texts, rows in _encoded(batches, "row"):
            chunk = _Chunk.of(texts)
            own = pa.concat_arrays(rows)
            target = np.array(own.field("target").to_pylist(), bool)
            values = [_pack_keys(chunk.hashes), _pack(chunk.codes.astype(np.uint32)), _pack(chunk.sizes), _pack(target)]
            counts = [int(chunk.sizes.sum()), int(chunk.sizes[target].sum())]
            listed = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own.field("doc"))
            columns = [pa.array([number], pa.int64()), *[pa.array([v], pa.binary()) for v in values], *[pa.array([c], pa.int64()) for c in counts], listed]
            yield pa.RecordBatch.from_arrays(columns, names=whole.names)
            number += 1

    return store(rows.select("text", F.struct("doc", "target").alias("row")).mapInArrow(encode, whole), "chunks")


def _chunk_of(batch: pa.RecordBatch | pa.Table, i: int = 0) -> _Chunk:
    hashes, codes, sizes = (batch.column(n)[i].as_py() for n in _PACKED)
    return _Chunk(_unpack_keys(hashes), _unpack(codes, np.uint32).astype(np.int64), _unpack(sizes, np.int64))


def _scored(chunks: DataFrame, replies: DataFrame, model: PairModel) -> DataFrame:
    """The documents of the chunks with their losses, by the counts that the blocks sent each chunk."""
    kinds = zip(_MADE, (LongType(), DoubleType(), DoubleType(), DoubleType()), strict=True)
    scored = StructType([StructField("doc", chunks.schema["docs"].dataType.elementType), *[StructField(n, k) for n, k in kinds]])
    loss, sums = replace(model, cells=None).loss, (model.pairs, model.pairs_target)

    def score(chunks: pa.Table, counts: pa.Table) -> pa.Table:
        chunk = _chunk_of(chunks)
        keys, pair_of, before, pairs, contexts = chunk.cells()
        order, counts = _in_order(keys, before, contexts), counts.sort_by("block")
        first, second = pairs // len(contexts), pairs % len(contexts)
        doc_of = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
        scale = sums[1] / sums[0] if sums[0] else 0.0
        means = []
        for name, by, total in (("n_target", 1.0, sums[1]), ("n", scale, sums[0] * scale)):
            n = np.zeros(len(keys), np.float64)
            n[order] = _join([_unpack(c, np.int64) for c in counts.column(name).to_pylist()], np.int64) * by
            word, context = n[len(pairs) : len(keys) - len(contexts)], n[len(keys) - len(contexts) :]
            losses = loss(n[: len(pairs)], word[second], context[first], total)
            means.append(np.bincount(doc_of, losses[pair_of], len(chunk.sizes)) / np.maximum(chunk.sizes, 1))
        without = chunk.sizes == 0
        columns = [pa.array(m, pa.float64(), mask=without) for m in (*means, means[0] - means[1])]
        own = pa.chunked_array([c.flatten() for c in chunks.column("docs").chunks]).combine_chunks()
        own = own if isinstance(own, pa.Array) else pa.concat_arrays(own.chunks)
        return pa.Table.from_arrays([own, pa.array(chunk.sizes, pa.int64()), *columns], names=scored.names)

    sent = chunks.select("chunk", *_PACKED, "docs")
    return sent.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, scored).select("doc.*", *_MADE)


def score_corpus(docs: DataFrame, target: DataFrame, keep: Sequence[str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score_documents`` of ``docs`` by the models of ``fit_models``, when both read the same documents.

    Texts are cut into words once. Cells go to their blocks with their counts, and
    the sums straight back to the chunks they came from: neither a table of cells
    is stored nor are keys sent a second time. One row of sums, and the number of
    different words, reach the driver. Nulls, empty texts, repeated rows, empty
    tables and clashing columns as in ``score_documents``.
    """
    bits = block_bits(_chars(docs, text))
    chunks = _chunked(_marked(_rows(docs, keep, F.col(text).alias("text"), F.col(doc_id).alias("id")), target, doc_id))
    pairs, pairs_target = chunks.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in ("n", "n_target")]).first()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("hashes").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_unpack_keys(packed).view(np.int64))], names=["hash"])

    n_words = chunks.select("hashes").mapInArrow(hashes, "hash BIGINT").distinct().count()
    sent = StructType([*_TOLD.fields[:2], StructField("keys", BinaryType()), *_TOLD.fields[2:]])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                chunk = _chunk_of(batch, i)
                rows = _messages(chunk, np.repeat(_unpack(batch.column("wanted")[i].as_py(), np.bool_), chunk.sizes), bits)
                if rows:
                    blocks, *packed = zip(*rows, strict=True)
                    number = batch.column("chunk")[i].as_py()
                    columns = [pa.array([number] * len(rows), pa.int64()), pa.array(blocks, pa.int64()), *[pa.array(p, pa.binary()) for p in packed]]
                    yield pa.RecordBatch.from_arrays(columns, names=sent.names)

    def reply(part: pa.Table) -> pa.Table:
        lists = [_unpack_keys(k) for k in part.column("keys").to_pylist()]
        ends = np.cumsum([len(own) for own in lists])[:-1]
        place = np.unique(np.concatenate(lists), return_inverse=True)[1]
        out = []
        for name in ("n", "n_target"):
            sums = np.zeros(place.max() + 1, np.int64)
            np.add.at(sums, place, np.concatenate([_unpack(c, np.int64) for c in part.column(name).to_pylist()]))
            out.append(pa.array([_pack(own) for own in np.split(sums[place], ends)], pa.binary()))
        return pa.Table.from_arrays([part.column("chunk"), part.column("block"), *out], names=_TOLD.names)

    replies = chunks.select("chunk", *_PACKED, "wanted").mapInArrow(send, sent).groupBy("block").applyInArrow(reply, _TOLD)
    return _scored(chunks, replies, PairModel(None, bits, pairs, pairs_target, n_words))


def score_documents(docs: DataFrame, model: PairModel, keep: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, loss_target, loss_background, score``; losses in nats a token.

    Texts without tokens, null and empty ones among them, have no losses and no
    score (null). Whole texts are scored. ``keep`` names the columns to return, all
    unless given; columns of the new names are replaced. Repeated rows are scored
    each. An empty table gives an empty one.
    """
    asked = StructType([*_TOLD.fields[:2], StructField("keys", BinaryType())])
    bits = model.bits

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                keys, _, before, _, contexts = _chunk_of(batch, i).cells()
                keys = keys[_in_order(keys, before, contexts)]
                found = [(block, _pack_keys(keys[at])) for block, at in _by_block(keys, bits)]
                if found:
                    blocks, own = zip(*found, strict=True)
                    number = batch.column("chunk")[i].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(found), pa.int64()), pa.array(blocks, pa.int64()), pa.array(own, pa.binary())], names=asked.names
                    )

    def tell(wanted: pa.Table, cells: pa.Table) -> pa.Table:
        if len(cells):
            keys = _unpack_keys(cells.column("keys")[0].as_py())
            counts = [_unpack(cells.column(n)[0].as_py(), np.int64) for n in ("n", "n_target")]
        # A block that no chunk asks gives no rows.
        out: list[list[bytes]] = [[], []]
        for packed_keys in wanted.column("keys").to_pylist():
            own = _unpack_keys(packed_keys)
            if len(cells):
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                known = keys[place] == own
            for i, into in enumerate(out):
                # What was never counted is zero.
                into.append(_pack(np.where(known, counts[i][place], 0) if len(cells) else np.zeros(len(own), np.int64)))
        return pa.Table.from_arrays([wanted.column("chunk"), wanted.column("block"), *[pa.array(o, pa.binary()) for o in out]], names=_TOLD.names)

    chunks = _chunked(_rows(docs, keep, F.col(text).alias("text"), F.lit(False).alias("target")))
    requests = chunks.select("chunk", *_PACKED).mapInArrow(ask, asked)
    # Where much more is scored than was fitted, several tasks answer for a block.
    salts = max(1, _chars(docs, text) // (LARGEST_BLOCK_CHARS << bits))
    requests = requests.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
    cells = model.cells.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    on = ("block", "salt")
    replies = requests.groupBy(*on).cogroup(cells.groupBy(*on)).applyInArrow(tell, _TOLD)
    return _scored(chunks, replies, model)


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never toxic; of contradicting labels the worse counts."""
    worst = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return worst.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
