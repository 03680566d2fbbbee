"""How the tokens of two tokenizers lie over each other in the same text.

Within a batch, ``merge_asof`` finds for each token's start the token of the other
side that covers it; both directions together give all overlaps. Where the two
tokens of an overlap end alike, both sides break, and these places cut a document
into groups. All pairs of tokens of a group are links.

Documents are first cut into cells, at spaces where neither side can go on. Tokens,
groups and links of a document are those of its cells one after the other, so the
equal cells of a batch are encoded and aligned once, with the cell as the key.

In how many documents a pair of ids is linked is counted over the whole corpus.
Documents are kept in chunks of bounded size, each with one row for every different
pair in it; documents refer to those rows by number. So what is shuffled to count
the pairs, and to bring the counts back, are the pairs of chunks and never links.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from ..storage import store
from .common import BROADCAST_BYTES
from .tokencount import batches_of
from .wordbpe import _byte_symbols

# Characters of texts, and of different cells, worked on in one step.
STEP, PORTION = 8 << 20, 1 << 20
# Pairs of documents in a chunk, and groups with more links are counted by different ids.
CHUNK_PAIRS, WIDE = 1 << 22, 1 << 12
# Pairs of a chunk in one row of the stored table.
ROW_PAIRS = 1 << 15
# Bytes of cells encoded as one text.
_TEXT = 1 << 14
_SPACE = "▁"
# A space between characters that are white space to neither side: both start a token there.
_BREAK = re.compile("(?<=[!-~\u00a1-\u024f]) (?=[!-~\u00a1-\u024f])")

ALIGNED = StructType(
    [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")] + [StructField("groups_sha256", StringType())]
)
MADE = (*ALIGNED.names, "n_best", "count_sum")


class Pair:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        as_byte = {symbol: byte for byte, symbol in enumerate(_byte_symbols())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(as_byte[c] for c in token) if all(c in as_byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.width_a, self.width_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # No token of side B has a space within, so neither side goes on over such a break.
        self.breaks = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def cells(self, text: str) -> list[str]:
        """The parts of a text that either side encodes alike on their own; the spaces between are left out.

        Both sides get a space before each part.
        """
        return _BREAK.split(text) if self.breaks else [text]

    def encode(self, cells: Sequence[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The tokens of both sides for each cell, none where they do not spell a space and the cell.

        Cells that stand next to each other in one text break where they meet, so
        they are encoded as texts of some length.
        """
        ends = np.cumsum([len(c.encode()) + 1 for c in cells])
        texts, first = [], [0]
        for end in range(1, len(cells) + 1):
            if end == len(cells) or not self.breaks or not _meet(cells[end - 1], cells[end]) or ends[end - 1] - ends[first[-1]] > _TEXT:
                texts.append(" ".join(cells[first[-1] : end]))
                first.append(end)
        spaced = [" " + t for t in texts]
        found = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.b.encode(texts, num_threads=1)
        sides, odd = [], []
        for ids, spelling, widths in zip(found, (self.bytes_a, self.bytes_b), (self.width_a, self.width_b), strict=True):
            odd += [i for i, t in enumerate(spaced) if b"".join(map(spelling.__getitem__, ids[i])) != t.encode()]
            sides.append((ids, widths))
        if odd and len(cells) > 1:
            return self._apart(cells, texts, first, set(odd))
        if odd:
            return tuple(_tokens(np.empty(0, np.int64), self.width_a, ends[:0]) for _ in sides)
        return tuple(_tokens(np.concatenate([np.array(i, np.int64) for i in ids]), widths, ends) for ids, widths in sides)

    def _apart(self, cells, texts, first, odd) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The same where a text is not spelled as it stands: the cells of such texts on their own."""
        parts = []
        for i in range(len(texts)):
            alone = i in odd
            for start in range(first[i], first[i + 1]) if alone else (first[i],):
                stop = start + 1 if alone else first[i + 1]
                parts.append([frame.assign(doc=frame["doc"] + start) for frame in self.encode(cells[start:stop])])
        return tuple(pd.concat([p[side] for p in parts], ignore_index=True).assign(at=lambda f: np.arange(len(f))) for side in (0, 1))


def _meet(left: str, right: str) -> bool:
    """Whether a space between two cells is a break."""
    return all("!" <= c <= "~" or "\u00a1" <= c <= "\u024f" for c in (left[-1], right[0]))


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> Pair:
    """Once per Python worker."""
    return Pair(path_a, path_b)


def _tokens(ids: np.ndarray, widths: np.ndarray, cell_ends: np.ndarray) -> pd.DataFrame:
    """One row a token: cell, id, first byte and the byte after the last, counted over all cells."""
    sizes = widths[ids]
    ends = np.cumsum(sizes)
    doc = np.searchsorted(cell_ends, ends, side="left")
    return pd.DataFrame({"doc": doc, "id": ids, "start": ends - sizes, "end": ends, "at": np.arange(len(ids))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens that share bytes: ``at_a, at_b, end_a, end_b``, each pair once."""
    sides = [x[["doc", "start", "end", "at"]].sort_values("start", kind="stable") for x in (a, b)]
    names = ("_a", "_b")
    from_a = pd.merge_asof(*sides, on="start", by="doc", suffixes=names)
    from_b = pd.merge_asof(*sides[::-1], on="start", by="doc", suffixes=names[::-1])
    both = pd.concat([from_a, from_b])[["at_a", "at_b", "end_a", "end_b"]]
    # Tokens that start alike find each other from both sides.
    return both[~pd.Series(both["at_a"].to_numpy() << 32 | both["at_b"].to_numpy()).duplicated().to_numpy()]


class Aligned:
    """Groups of some documents, and the pairs of ids that they link."""

    def __init__(self, a: pd.DataFrame, b: pd.DataFrame, n_docs: int, size_b: int):
        """``a`` and ``b`` are the tokens of both sides; a pair of ids is ``id_a * size_b + id_b``."""
        self.a, self.b, self.n_docs, self.size_b = a, b, n_docs, size_b
        found = overlaps(a, b)
        alike = found[found["end_a"] == found["end_b"]]
        self.group_a = self._groups(len(a), alike["at_a"].to_numpy())
        self.group_b = self._groups(len(b), alike["at_b"].to_numpy())
        self.n_groups = len(alike)
        self.first_a = np.searchsorted(self.group_a, np.arange(self.n_groups + 1))
        self.first_b = np.searchsorted(self.group_b, np.arange(self.n_groups + 1))
        self.doc = a["doc"].to_numpy()[self.first_a[:-1]]

    @staticmethod
    def _groups(n: int, last: np.ndarray) -> np.ndarray:
        """The number of each token's group, from the tokens that end one."""
        ends = np.zeros(n, np.int64)
        ends[last] = 1
        return np.cumsum(ends) - ends

    def counts(self) -> dict[str, np.ndarray]:
        per_doc = lambda x, w=None: np.bincount(x, w, minlength=self.n_docs).astype(np.int64)
        links = np.diff(self.first_a) * np.diff(self.first_b)
        total = np.zeros(self.n_docs, np.int64)
        np.add.at(total, self.doc, links)
        return {"n_a": per_doc(self.a["doc"]), "n_b": per_doc(self.b["doc"]), "n_groups": per_doc(self.doc), "n_links": total}

    def spelled(self) -> list[str]:
        """The groups of each document as text."""
        spelled = []
        for frame, first in ((self.a, self.first_a), (self.b, self.first_b)):
            ids, at = list(map(str, frame["id"].tolist())), first.tolist()
            spelled.append([ids[i] if j - i == 1 else ",".join(ids[i:j]) for i, j in zip(at, at[1:])])
        groups = list(map("|".join, zip(*spelled, strict=True)))
        where = np.searchsorted(self.doc, np.arange(self.n_docs + 1)).tolist()
        return [";".join(groups[i:j]) for i, j in zip(where, where[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair and number of links, sorted, each document's pair once."""
        size_a, size_b = np.diff(self.first_a), np.diff(self.first_b)
        links = size_a * size_b
        ids_a, ids_b = self.a["id"].to_numpy(), self.b["id"].to_numpy()
        narrow = np.flatnonzero(links <= WIDE)
        group = np.repeat(narrow, links[narrow])
        inner = np.arange(len(group)) - np.repeat(np.cumsum(links[narrow]) - links[narrow], links[narrow])
        over, under = np.divmod(inner, size_b[group])
        doc = [self.doc[group]]
        code = [ids_a[self.first_a[group] + over] * self.size_b + ids_b[self.first_b[group] + under]]
        times = [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(links > WIDE):
            a, n_a = np.unique(ids_a[self.first_a[g] : self.first_a[g + 1]], return_counts=True)
            b, n_b = np.unique(ids_b[self.first_b[g] : self.first_b[g + 1]], return_counts=True)
            code.append((a[:, None] * self.size_b + b).reshape(-1))
            times.append((n_a[:, None] * n_b).reshape(-1))
            doc.append(np.full(len(code[-1]), self.doc[g]))
        return _summed(*map(np.concatenate, (doc, code, times)))


def _portions(cells: Sequence[str]) -> Iterator[Sequence[str]]:
    start = size = 0
    for i, cell in enumerate(cells):
        if size and size + len(cell) > PORTION:
            yield cells[start:i]
            start, size = i, 0
        size += len(cell) + 1
    if start < len(cells):
        yield cells[start:]


def align_texts(pair: Pair, texts: Sequence[str | None]) -> tuple[dict[str, np.ndarray], list[str], tuple[np.ndarray, ...]]:
    """Counts and digests of texts, and text, pair of ids and number of links, sorted."""
    number: dict[str, int] = {}
    numbers, ends = [], [0]
    for text in texts:
        numbers += [number.setdefault(c, len(number)) for c in (pair.cells(text) if text else ())]
        ends.append(len(numbers))
    parts, spelled, done = [], [], 0
    for portion in _portions(list(number)):
        found = Aligned(*pair.encode(portion), len(portion), len(pair.bytes_b))
        cell, code, times = found.pairs()
        parts.append((found.counts(), cell + done, code, times))
        spelled += found.spelled()
        done += len(portion)
    none = np.empty(0, np.int64)
    own = {n: np.concatenate([none, *[p[0][n] for p in parts]]) for n in ALIGNED.names[:-1]}
    cell_of, code, times = (np.concatenate([none, *[p[i] for p in parts]]) for i in (1, 2, 3))

    # A text with a cell that one side does not spell has no tokens.
    cells, ends = np.array(numbers, np.int64), np.array(ends)
    text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
    odd = np.bincount(text_of[own["n_a"][cells] == 0], minlength=len(texts)) > 0
    cells, text_of = cells[~odd[text_of]], text_of[~odd[text_of]]
    ends = np.searchsorted(text_of, np.arange(len(texts) + 1))
    totals = {n: np.diff(np.concatenate([[0], np.cumsum(x[cells])])[ends]) for n, x in own.items()}
    listed = [spelled[c] for c in cells.tolist()]
    digests = [hashlib.sha256(";".join(listed[i:j]).encode()).hexdigest() if i < j else "" for i, j in zip(ends, ends[1:])]

    # The pairs of a text's different cells, each as often as the cell stands there.
    key, often = np.unique(text_of << 32 | cells, return_counts=True)
    text_of, cells = key >> 32, key & 0xFFFFFFFF
    first = np.searchsorted(cell_of, np.arange(len(number) + 1))
    sizes = np.diff(first)[cells]
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first[cells], sizes)
    return totals, digests, _summed(np.repeat(text_of, sizes), code[at], times[at] * np.repeat(often, sizes))


def _summed(doc: np.ndarray, code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's pair once, sorted."""
    order = np.lexsort((code, doc))
    doc, code, times = doc[order], code[order], times[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    first = np.flatnonzero(new)
    return doc[first], code[first], np.add.reduceat(times, first) if len(first) else times


def pack(places: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and how often each stands, small."""
    steps = np.diff(places, prepend=0).astype("<u4")
    often = np.where(times > 0xFF, 0, times).astype(np.uint8)
    rare = times[times > 0xFF].astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(places).to_bytes(4, "little") + zlib.compress(planes + often.tobytes() + rare.tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(packed[:4], "little")
    plain = np.frombuffer(zlib.decompress(packed[4:]), np.uint8)
    steps = np.ascontiguousarray(plain[: 4 * n].reshape(4, n).T).view("<u4").reshape(-1)
    times = plain[4 * n : 5 * n].astype(np.int64)
    times[times == 0] = plain[5 * n :].view("<u8") if 5 * n < len(plain) else 0
    return np.cumsum(steps, dtype=np.int64), times


_CHUNK = [StructField("chunk", StringType()), StructField("links", BinaryType())]
_PAIRS = [StructField("first", IntegerType()), StructField("codes", ArrayType(LongType())), StructField("n_docs", ArrayType(LongType()))]


class _Chunk:
    """Documents of a task until they have enough pairs to be written with a list of their own."""

    def __init__(self, names: Sequence[str], doc_type: pa.DataType):
        self.names, self.doc_type = names, doc_type
        self.name, self.rows, self.pairs, self.size = uuid.uuid4().hex, [], [], 0

    def add(self, docs: pa.Array, counts: dict[str, np.ndarray], digests: list[str], pairs: tuple[np.ndarray, ...]) -> None:
        self.rows.append((docs, counts, digests))
        self.pairs.append(pairs)
        self.size += len(pairs[0])

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The documents, whose links go by place in the list of pairs, and that list in rows."""
        if not self.rows:
            return
        codes, n_docs = np.unique(np.concatenate([p[1] for p in self.pairs]), return_counts=True)
        for (docs, counts, digests), (doc, code, times) in zip(self.rows, self.pairs, strict=True):
            places, ends = np.searchsorted(codes, code), np.searchsorted(doc, np.arange(len(docs) + 1))
            links = [pack(places[i:j], times[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            columns = [docs, *[pa.array(counts[n]) for n in ALIGNED.names[:-1]], pa.array(digests), pa.array([self.name] * len(docs)), pa.array(links)]
            nothing = [pa.nulls(len(docs), t) for t in (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *nothing], names=self.names)
        for at in range(0, len(codes), ROW_PAIRS):
            part = slice(at, at + ROW_PAIRS)
            empty = [pa.nulls(1, t) for t in (self.doc_type, *[pa.int64()] * 4, pa.string())]
            lists = [pa.array([x[part].tolist()], pa.list_(pa.int64())) for x in (codes, n_docs)]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([self.name]), pa.nulls(1, pa.binary()), pa.array([at], pa.int32()), *lists], names=self.names)


def _count_links(chunk: pa.Table, counts: pa.Table, names: Sequence[str]) -> pa.Table:
    """``n_best`` and ``count_sum`` of a chunk's documents, from the counts of its pairs."""
    order = np.argsort(counts.column("place").to_numpy())
    count, best = (counts.column(n).to_numpy()[order].astype(np.int64) for n in ("count", "best"))
    found = []
    for packed in chunk.column("links").to_pylist():
        places, times = unpack(packed)
        found.append((int(times @ best[places]), int(times @ count[places])))
    columns = [chunk.column(n) for n in names[:-2]]
    return pa.Table.from_arrays([*columns, *[pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]], names=list(names))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, keep: Sequence[str] | None = None, text: str = "text", chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``path_a`` is a byte-level file of the tokenizers library, which encodes a space
    and the text, ``path_b`` a sentencepiece model, which adds the space itself; no
    special tokens, and their strings are plain text. Both files must be there on
    every worker. Token counts, groups and links are those of the document.
    ``count_sum`` adds up, over its links, how many documents of the corpus hold the
    link's pair of ids; ``n_best`` counts the links whose number is the highest for
    their id of side A, ties included. ``groups_sha256`` is the hash of
    ``a1,a2|b1;a3|b2,b3``. Null and empty texts and those that either side does not
    spell as they stand have no tokens: zeros, and an empty text for the hash.
    Repeated rows are documents of their own; ids may be null or repeat. An empty
    table stays so. ``keep`` names the columns to return, all unless given; columns
    of the new names are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in MADE]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("text"))
    # Rows of pairs have no document.
    doc_field = [StructField("doc", rows.schema["doc"].dataType)]
    schema = StructType([*doc_field, *ALIGNED, *_CHUNK, *_PAIRS])
    sizes = len(_pair(path_a, path_b).bytes_a), len(_pair(path_a, path_b).bytes_b)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, chunk = _pair(path_a, path_b), None
        for batch in batches:
            for start, end in batches_of(batch.column("text"), STEP):
                part = batch.slice(start, end - start)
                found = align_texts(pair, part.column("text").to_pylist())
                chunk = chunk or _Chunk(schema.names, part.column("doc").type)
                chunk.add(part.column("doc"), *found)
                if chunk.size >= chunk_pairs:
                    yield from chunk.batches()
                    chunk = None
        if chunk:
            yield from chunk.batches()

    aligned = store(rows.mapInArrow(align, schema), "aligned")
    listed = aligned.filter("codes IS NOT NULL").select("chunk", "first", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("pos", "pair"))
    pairs = listed.select("chunk", (F.col("first") + F.col("pos")).alias("place"), "pair.*")
    counted = pairs.withColumn("count", F.sum("n_docs").over(Window.partitionBy("codes")))
    id_a = F.floor(F.col("codes") / sizes[1]).cast("int")
    counted = store(counted.select("chunk", "place", id_a.alias("a"), "count"), "pair-counts")
    # One row for each token of side A, of which there are as many as its file has.
    highest = counted.groupBy("a").agg(F.max("count").alias("highest"))
    highest = F.broadcast(highest) if sizes[0] * 32 <= BROADCAST_BYTES else highest
    numbers = counted.join(highest, "a").select("chunk", "place", "count", (F.col("count") == F.col("highest")).alias("best"))

    names = ["doc", *ALIGNED.names, "n_best", "count_sum"]
    out = StructType([*doc_field, *ALIGNED, StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def join(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        return _count_links(chunk, counts, names)

    whole = aligned.filter("codes IS NULL").select("chunk", "doc", *ALIGNED.names, "links")
    scored = whole.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(join, out)
    return scored.select("doc.*", *MADE)
