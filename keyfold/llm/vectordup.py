"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by the pivots nearest to it, in order. Near vectors see
the pivots in nearly the same order, so they share most of their first ones. The
inverted lists hold, for every set of ``SHARED`` pivots, the vectors that have
them among their first ``PREFIX``; two vectors meet in a list if they share that
many. What meets is verified by the cosine in double precision.

Pivots are taken from a bounded sample, spread out; all vectors are indexed. Equal
vectors of a label are one entry with a count. Long lists are cut into blocks and
compared block against block, so no task holds a whole list, and a pair that
meets in several lists counts in the list of its smallest shared pivots only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..storage import store
from .graph import connected_components

SIMILAR = 0.98
# Vectors that pivots are chosen from, and how many are.
SAMPLE, PIVOTS = 2048, 256
# Two pivots are less alike than this, so that their order means something.
SPREAD = 0.6
PREFIX, SHARED = 7, 3
BLOCK = 1024
_BITS = 16


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def choose_pivots(classes: DataFrame) -> np.ndarray:
    """Up to ``PIVOTS`` unit vectors, none too near another, from ``SAMPLE`` vectors by hash."""
    rows = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()
    if not rows:
        return np.empty((0, 1))
    width = max(len(r.vector) for r in rows)
    chosen = np.empty((0, width))
    for row in rows:
        padded = np.zeros((1, width))
        padded[0, : len(row.vector)] = row.vector
        vector = _unit(padded)
        if not len(chosen) or (chosen @ vector[0]).max() < SPREAD:
            chosen = np.vstack([chosen, vector])
        if len(chosen) == PIVOTS:
            break
    return chosen


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Unit rows, padded or cut to a width."""
    lists = vectors.to_pylist()
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        v = v[:width]
        out[i, : len(v)] = v
    return _unit(np.where(np.abs(out).max(axis=1, keepdims=True) > 0, out, 1.0))


def describe(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rep`` with ``prefix``, its nearest pivots by number, and ``keys``, one for each set of them."""
    prefix = min(PREFIX, len(pivots))
    shared = min(SHARED, prefix)
    sets = np.array(list(combinations(range(prefix), shared)))
    schema = StructType([StructField("rep", LongType()), StructField("prefix", ArrayType(LongType())), StructField("keys", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column("vector"), pivots.shape[1]) @ pivots.T
            first = np.argsort(-near, axis=1, kind="stable")[:, :prefix]
            picked = np.sort(first, axis=1)[:, sets]
            keys = np.zeros(picked.shape[:2], np.int64)
            for i in range(shared):
                keys = (keys << _BITS) | picked[:, :, i]
            columns = [batch.column("rep"), pa.array(list(first), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return classes.select("rep", "vector").mapInArrow(run, schema)


def _owners(a: np.ndarray, b: np.ndarray, shared: int) -> np.ndarray:
    """The key of the smallest shared pivots of rows of sorted prefixes; each row shares enough."""
    both = (a[:, :, None] == b[:, None, :]).any(axis=2)
    order = np.argsort(~both, axis=1, kind="stable")[:, :shared]
    smallest = np.take_along_axis(a, order, axis=1)
    key = np.zeros(len(a), np.int64)
    for i in range(shared):
        key = (key << _BITS) | smallest[:, i]
    return key


def _compare(key: int, group: dict[str, np.ndarray], shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Node, links and root of the rows of one pair of blocks that link with others."""
    unit, block, prefix = group["unit"], group["block"], group["prefix"]
    alike = np.triu(unit @ unit.T >= SIMILAR, 1)
    if block[0] != block[-1] or (block != block[0]).any():
        alike &= block[:, None] != block[None, :]
    x, y = np.nonzero(alike)
    if len(x):
        own = _owners(prefix[x], prefix[y], shared) == key
        x, y = x[own], y[own]
    if not len(x):
        return None
    links = np.zeros(len(block), np.int64)
    np.add.at(links, x, group["copies"][y])
    np.add.at(links, y, group["copies"][x])
    root = np.arange(len(block))
    while True:
        low = np.minimum(root[x], root[y])
        after = root.copy()
        np.minimum.at(after, x, low)
        np.minimum.at(after, y, low)
        if (after == root).all():
            break
        root = after
    linked = links > 0
    return group["rep"][linked], links[linked], group["rep"][root[linked]]


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row a row of ``vectors``.

    Rows link if their labels are equal and not null, their vectors as long as
    each other, and the cosine is at least 0.98. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest id that links lead to, its
    own included; ``kept`` tells whether the row has it. Vectors that are null,
    zero or hold null or non-finite components link with nothing, and so do rows
    without an id, which are kept. Rows of equal vectors link with each other.
    The index may miss links: of pairs at exactly 0.98 it finds about 99.8 %. An
    empty table stays so.
    """
    # Zero has one sign, so that equal vectors are equal bit by bit.
    plain = F.transform(F.col(vector), lambda x: x + F.lit(0.0).cast("float"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), plain.alias("vector"))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    keys = (F.xxhash64("label", "vector").alias("k1"), F.xxhash64(F.lit(1), "vector", "label").alias("k2"))
    marked = rows.withColumn("fit", fit)
    good = marked.filter("fit")
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = store(classes.select(*keys, "label", "vector", F.size("vector").alias("width"), "rep", "copies"), "classes")
    pivots = choose_pivots(classes)
    shared = min(SHARED, PREFIX, max(1, len(pivots)))
    described = store(describe(classes, pivots) if len(pivots) else classes.select("rep", F.array().cast("array<bigint>").alias("prefix"), F.array().cast("array<bigint>").alias("keys")), "described")

    where = ["label", "width", "key"]
    entries = described.join(classes.select("rep", "label", "width"), "rep").select("rep", "label", "width", F.explode("keys").alias("key"))
    entries = store(entries, "entries")
    # Lists of one entry, by far the most, go before any vector moves.
    lists = entries.groupBy(*where).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = entries.join(lists, where).withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = crowded.withColumn("block", own).withColumn("other", other)
    paired = paired.select(*where, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep")
    full = paired.join(classes.select("rep", "vector", "copies"), "rep").join(described.select("rep", "prefix"), "rep")
    task = [*where, "low", "high"]
    ordered = full.repartition(*task).sortWithinPartitions(*task)
    schema = StructType([StructField(n, LongType()) for n in ("rep", "links", "root")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            starts = _starts(rows, task)
            # The last group may go on in the next batch.
            yield from _groups(rows, starts, shared, schema)
            rest = rows.slice(starts[-1]) if len(starts) else rows
        if rest is not None and rest.num_rows:
            yield from _groups(rest, np.array([0, rest.num_rows]), shared, schema)

    found = store(ordered.mapInArrow(run, schema), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = (
        classes.select("k1", "k2", "rep", "copies")
        .join(links, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "k1",
            "k2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = good.select("vec_id", *keys).join(counted, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = marked.filter(~F.col("fit")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _starts(rows: pa.Table, task: list[str]) -> np.ndarray:
    """Where groups begin among sorted rows."""
    if not rows.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in task:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _groups(rows: pa.Table, starts: np.ndarray, shared: int, schema: StructType) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each group but the last start's."""
    if len(starts) < 2:
        return
    rows = rows.slice(0, int(starts[-1])).combine_chunks()
    keys = rows.column("key").to_numpy()
    plain = {name: rows.column(name).to_numpy() for name in ("rep", "copies", "block", "width")}
    prefix = np.sort(np.array(rows.column("prefix").to_pylist(), dtype=np.int64), axis=1)
    flat = rows.column("vector").combine_chunks()
    values, offsets = flat.flatten().to_numpy(), np.concatenate([[0], np.cumsum(plain["width"])])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a < 2:
            continue
        unit = _unit(values[offsets[a] : offsets[b]].reshape(b - a, -1))
        group = {"unit": unit, "prefix": prefix[a:b], **{n: plain[n][a:b] for n in ("rep", "copies", "block")}}
        if (got := _compare(int(keys[a]), group, shared)) is not None:
            out.append(got)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=schema.names)
