"""Hard negatives of anchors, by filtering with summaries of vector segments.

A vector is cut into equal segments, and of each the mean and the deviation from
it (the root of the sum of squares) are kept. For two vectors, the product of the
means of a segment times its width, plus or minus the product of the deviations,
bounds what the segment adds to the inner product. Summed up over few segments,
then over more, these bounds rule out rows whose score cannot be among those
asked for; only what is left is scored, exactly.

Anchors go to the workers in groups of bounded size, one after the other, and
every group is held against all rows in blocks. Each task keeps the few best rows
of each anchor, so what is shuffled are a few rows per anchor and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..storage import store

POSITIVES, NEGATIVES = 5, 5
# A negative has at least this share, in hundredths, of the positive's score.
LEAST = 80
UNIT = 256.0
# Widths of segments, coarse first.
WIDTHS = (16, 4)
# Bytes of anchors that are sent to the workers at once, and rows scored in one step.
GROUP_BYTES, ROWS, ANCHORS = 16 << 20, 4096, 512
# Sums of products below this are exact in double precision.
EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


class Block:
    """Vectors of one length: whole components, and summaries of their segments."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.tags, self.labels, self.vectors = ids, tags, labels, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.levels = [self._summary(w) for w in WIDTHS]

    def _summary(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Means, times the root of the segment's width, and deviations, by row and segment."""
        n, size = self.vectors.shape
        edges = np.arange(0, size, width)
        widths = np.diff([*edges, size])
        if not size:
            return np.zeros((n, 0)), np.zeros((n, 0))
        total = np.add.reduceat(self.vectors, edges, axis=1)
        square = np.add.reduceat(self.vectors * self.vectors, edges, axis=1)
        mean = total / np.sqrt(widths)
        return mean, np.sqrt(np.maximum(square - mean * mean, 0))

    def __getitem__(self, at) -> Block:
        part = object.__new__(Block)
        part.ids, part.tags, part.labels, part.vectors, part.norms = self.ids[at], self.tags[at], self.labels[at], self.vectors[at], self.norms[at]
        part.levels = [(m[at], d[at]) for m, d in self.levels]
        return part

    def __len__(self) -> int:
        return len(self.ids)


def blocks_of(rows: pa.Table | pa.RecordBatch) -> dict[int, Block]:
    """Rows by the length of their vectors; components become floor(256 x)."""
    vectors = rows.column("vector")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(UNIT * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.cumsum(sizes) - sizes
    plain = [rows.column(n).to_numpy() for n in ("vec_id", "tag", "label")]
    out = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        matrix = flat[starts[at][:, None] + np.arange(size)]
        out[size] = Block(*[p[at] for p in plain], matrix)
    return out


def exact_scores(a: Block, b: Block) -> np.ndarray:
    """Inner products of whole components, all rows of one with all of the other."""
    bound = a.norms.max(initial=0) * b.norms.max(initial=0)
    if bound < EXACT / 2:
        return a.vectors @ b.vectors.T
    # Beyond double precision; a score beyond BIGINT fails the job.
    whole = [[[int(x) for x in row] for row in side.vectors.tolist()] for side in (a, b)]
    scores = [[sum(x * y for x, y in zip(u, v, strict=True)) for v in whole[1]] for u in whole[0]]
    return np.array(scores, np.int64).reshape(len(a), len(b))


def surviving(a: Block, b: Block, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which allowed pairs may score from ``low`` to ``high`` of their anchor, by ever narrower segments."""
    for (mean_a, off_a), (mean_b, off_b) in zip(a.levels, b.levels, strict=True):
        rows, columns = allowed.any(axis=1), allowed.any(axis=0)
        if not rows.any():
            break
        middle = mean_a[rows] @ mean_b[columns].T
        reach = off_a[rows] @ off_b[columns].T
        # What the sums may be off by.
        reach += 1e-9 * np.outer(a.norms[rows], b.norms[columns])
        fits = (middle + reach >= low[rows, None]) & (middle - reach <= high[rows, None])
        allowed = allowed.copy()
        allowed[np.ix_(rows, columns)] &= fits
    return allowed


def scored_pairs(a: Block, b: Block, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and score of the allowed pairs that score from ``low`` to ``high``."""
    allowed = surviving(a, b, allowed, low, high)
    rows, columns = np.flatnonzero(allowed.any(axis=1)), np.flatnonzero(allowed.any(axis=0))
    if not len(rows):
        return (np.empty(0, np.int64),) * 3
    scores = exact_scores(a[rows], b[columns])
    good = allowed[np.ix_(rows, columns)] & (scores >= low[rows, None]) & (scores <= high[rows, None])
    x, y = np.nonzero(good)
    return rows[x], columns[y], scores[x, y].astype(np.int64)


class Best:
    """The first rows of each slot by score, then id; slots are numbered from 0."""

    NAMES = ("slot", "score", "id", "tag")

    def __init__(self, slots: int, most: int):
        self.most = most
        self.kept = pd.DataFrame({n: np.empty(0, np.int64) for n in self.NAMES})
        # The score that a further row has to reach in a slot that is full.
        self.floor = np.full(slots, -np.inf)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> None:
        if not len(slot):
            return
        rows = pd.concat([self.kept, pd.DataFrame(dict(zip(self.NAMES, (slot, score, ids, tags), strict=True)))])
        rows = rows.iloc[np.lexsort((rows["tag"], rows["id"], -rows["score"], rows["slot"]))]
        place = rows.groupby("slot").cumcount()
        self.kept = rows[place.to_numpy() < self.most].reset_index(drop=True)
        full = rows[place.to_numpy() == self.most - 1]
        self.floor[full["slot"].to_numpy()] = full["score"].to_numpy()


class Search:
    """One group of anchors against the rows of a task.

    ``ranges`` has for each anchor the least and the greatest score of each of its
    slots; none for positives, which are the best rows of its own label.
    """

    def __init__(self, anchors: pa.Table, positives: bool):
        self.positives = positives
        self.blocks = blocks_of(anchors)
        slots = 1 if positives else POSITIVES
        self.low, self.high, self.best = {}, {}, {}
        for size, block in self.blocks.items():
            if positives:
                low = np.full((len(block), 1), -np.inf)
                high = -low
            else:
                low, high = _ranges(anchors, block)
            self.low[size], self.high[size] = low, high
            self.best[size] = Best(len(block) * slots, POSITIVES if positives else NEGATIVES)

    def feed(self, rows: pa.RecordBatch) -> None:
        for size, block in blocks_of(rows).items():
            anchors = self.blocks.get(size)
            if anchors is None:
                continue
            for b in range(0, len(block), ROWS):
                for a in range(0, len(anchors), ANCHORS):
                    self._step(size, anchors, slice(a, a + ANCHORS), block[slice(b, b + ROWS)])

    def _step(self, size: int, anchors: Block, at: slice, rows: Block) -> None:
        part, best = anchors[at], self.best[size]
        slots = self.low[size].shape[1]
        floor = best.floor.reshape(-1, slots)[at]
        low, high = np.maximum(self.low[size][at], floor), self.high[size][at]
        same = part.labels[:, None] == rows.labels[None, :]
        if self.positives:
            itself = (part.ids[:, None] == rows.ids[None, :]) & (part.tags[:, None] == rows.tags[None, :])
            allowed = same & ~itself
        else:
            allowed = ~same
        open_slots = low <= high
        least = np.where(open_slots, low, np.inf).min(axis=1)
        most = np.where(open_slots, high, -np.inf).max(axis=1)
        x, y, score = scored_pairs(part, rows, allowed, least, most)
        for slot in range(slots):
            fits = (score >= low[x, slot]) & (score <= high[x, slot])
            where = (at.start + x[fits]) * slots + slot
            best.add(where, score[fits], rows.ids[y[fits]], rows.tags[y[fits]])

    def results(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        for size, block in self.blocks.items():
            kept, slots = self.best[size].kept, self.low[size].shape[1]
            if len(kept):
                anchor, slot = np.divmod(kept["slot"].to_numpy(), slots)
                columns = [block.ids[anchor], block.tags[anchor], slot, kept["id"], kept["tag"], kept["score"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _ranges(anchors: pa.Table, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for each positive of the block's anchors."""
    known = {(i, t): s for i, t, s in zip(*(anchors.column(n).to_pylist() for n in ("vec_id", "tag", "scores")), strict=True)}
    low = np.full((len(block), POSITIVES), np.inf)
    high = np.full((len(block), POSITIVES), -np.inf)
    for row, key in enumerate(zip(block.ids.tolist(), block.tags.tolist(), strict=True)):
        for slot, score in enumerate(known[key]):
            low[row, slot], high[row, slot] = -(-LEAST * score // 100), score
    return low, high


_FOUND = StructType([StructField(n, LongType()) for n in ("anchor", "anchor_tag", "slot", "id", "tag", "score")])


def _search(rows: DataFrame, anchors: pa.Table, positives: bool) -> DataFrame:
    """The best rows of every task for each slot of a group of anchors."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, positives)
        for batch in batches:
            search.feed(batch)
        yield from search.results(_FOUND.names)

    return rows.mapInArrow(run, _FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first rows of each slot over all tasks, with their rank."""
    order = Window.partitionBy("anchor", "anchor_tag", "slot").orderBy(F.desc("score"), "id", "tag")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _by_group(anchors: DataFrame, search: Callable[[pa.Table], DataFrame]) -> DataFrame | None:
    """``search`` for every group of anchors, none larger than ``GROUP_BYTES``."""
    size = F.size("vector") * 8 + 64
    total = anchors.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]
    groups = -(-total // GROUP_BYTES)
    group = F.pmod(F.xxhash64("vec_id", "tag"), F.lit(max(1, groups)))
    parts = [search(anchors.filter(group == i).toArrow()) for i in range(groups)]
    return reduce(DataFrame.unionByName, parts) if parts else None


def hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components count as floor(256 x), and a score is the inner product of two
    vectors of the same length. An anchor is a row for whose id ``is_anchor`` holds;
    its positives are its first five other rows of the same label, higher scores
    first, then smaller ids. For each positive the first five rows of other labels
    are returned whose score is at least 80 hundredths of the positive's and not
    above it. Fewer if there are no more.

    Rows without id, label or vector, or with a component that is null or not
    finite, take no part. Rows alike in id, label and vector count once; different
    rows of one id are rows of their own, and so are anchors of one id. An empty
    table gives an empty result, and so does one without anchors.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = store(rows.distinct().withColumn("tag", F.xxhash64("label", "vector")), "vectors")
    anchors = rows.filter(is_anchor(F.col("vec_id")))
    positives = _by_group(anchors, lambda group: _search(rows, group, positives=True))
    if positives is None:
        nothing = rows.limit(0).select(F.col("vec_id").alias("anchor"), F.col("tag").alias("anchor_tag"))
        positives = nothing.select("*", *[F.lit(0).cast("bigint").alias(n) for n in ("slot", "id", "tag", "score")])
    positives = store(_first(positives, POSITIVES), "positives")
    scores = positives.groupBy("anchor", "anchor_tag").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores")
    )
    known = anchors.join(scores, (F.col("vec_id") == F.col("anchor")) & (F.col("tag") == F.col("anchor_tag")))
    known = store(known.select("vec_id", "tag", "label", "vector", "scores"), "anchors")
    negatives = _by_group(known, lambda group: _search(rows, group, positives=False))
    if negatives is None:
        negatives = positives.drop("rank").limit(0)
    ranked = _first(negatives, NEGATIVES)
    key = ["anchor", "anchor_tag", "slot"]
    chosen = positives.select("anchor", "anchor_tag", (F.col("rank") - 1).cast("bigint").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(chosen, key).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
