"""Which documents hold passages of a benchmark, by Wu-Manber search.

An item's windows are its runs of ``window`` words; an item of fewer words is one
window. Different windows are compiled into search tables of bounded size: a
benchmark too large for one set of tables is dealt out by hash over several, which
documents then pass one after the other. Each adds the words it hits and the items
it finds to those of the tables before it, so nothing but the windows is ever
shuffled, and documents need no id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..storage import store
from .tokencount import batches_of
from .wumanber import Patterns, Words

WINDOW = 10
# Windows and their bytes in one set of tables, which is what is sent to the workers at once.
PAIRS, PAIR_BYTES = 1 << 18, 32 << 20
_YIELD = 1 << 14

FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("spans", ArrayType(LongType())),
    ]
)
_PAIR = "item STRING, words BINARY"


def _words_of(texts: pa.Array) -> Words:
    """The words of texts; null has none."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.empty(0, np.uint8)
    return Words(data, offsets - offsets[0])


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item, words``: the different windows of each item, words parted by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, item in enumerate(batch.column("item").to_pylist()):
                words = _words_of(batch.column("text").slice(row, 1))
                last = max(1, len(words) - window + 1) if len(words) else 0
                for begin in range(0, last, _YIELD):
                    end = min(begin + _YIELD, last)
                    spelled = [words[i] for i in range(begin, min(end + window - 1, len(words)))]
                    runs = [b" ".join(spelled[i : i + window]) for i in range(end - begin)]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(runs), pa.string()), pa.array(runs, pa.binary())], names=["item", "words"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, _PAIR).distinct()


class Tables:
    """Compiled windows with the items that each belongs to; None is an item without an id."""

    def __init__(self, pairs: Sequence[tuple[str | None, bytes]]):
        by_window: dict[bytes, list[str]] = {}
        for item, words in pairs:
            owners = by_window.setdefault(bytes(words), [])
            if item is not None:
                owners.append(item)
        self.patterns = Patterns(list(by_window))
        self.owners = list(by_window.values())


def compile_windows(pairs: DataFrame, most: int = PAIRS, most_bytes: int = PAIR_BYTES) -> list[Broadcast]:
    """The tables of a stored table of windows, as many as keep each within its bounds."""
    spark = pairs.sparkSession
    size = F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    n, total = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    parts = max(1, -(-n // most), -(-total // most_bytes))
    part = F.pmod(F.xxhash64("words", "item"), F.lit(parts))
    tables = []
    for i in range(parts):
        rows = pairs.filter(part == i).collect()
        tables.append(spark.sparkContext.broadcast(Tables([(r["item"], r["words"]) for r in rows])))
    return tables


def _hit_words(words: Words, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word lies within one of the given ranges."""
    change = np.bincount(begins, minlength=len(words) + 1) - np.bincount(ends, minlength=len(words) + 1)
    return np.cumsum(change)[:-1] > 0


def _search(tables: Tables, texts: pa.Array, spans: list, items: list) -> list[pa.Array]:
    """The columns of ``FOUND`` for some texts, with what earlier tables found in them."""
    words = _words_of(texts)
    first = words.first
    begins, ends, pairs = [], [], []
    for size, begin, number in tables.patterns.search(words):
        begins.append(begin)
        ends.append(begin + size)
        row = np.searchsorted(first, begin, side="right") - 1
        pairs.append(np.unique(np.stack([row, number], axis=1), axis=0))
    for row, known in enumerate(spans):
        if known:
            own = first[row] + np.array(known, np.int64).reshape(-1, 2)
            begins.append(own[:, 0])
            ends.append(own[:, 1])
    found = {row: set(known) for row, known in enumerate(items) if known}
    for row, number in (tuple(p) for part in pairs for p in part.tolist()):
        found.setdefault(row, set()).update(tables.owners[number])
    none = np.empty(0, np.int64)
    hit = _hit_words(words, np.concatenate([none, *begins]), np.concatenate([none, *ends]))
    # Ranges of hit words; one that reaches into the next text is two.
    inner = np.zeros(len(words) + 1, bool)
    inner[first] = True
    edge = np.concatenate([[False], hit, [False]])
    starts = np.flatnonzero(hit & (~edge[:-2] | inner[:-1]))
    stops = np.flatnonzero(hit & (~edge[2:] | inner[1:])) + 1
    count = np.concatenate([[0], np.cumsum(hit)])
    row = np.searchsorted(first, starts, side="right") - 1
    flat = np.stack([starts - first[row], stops - first[row]], axis=1).reshape(-1)
    offsets = 2 * np.searchsorted(starts, first)
    return [
        pa.array(np.diff(first), pa.int64()),
        pa.array(np.diff(count[first]), pa.int64()),
        pa.array([sorted(found.get(r, ())) for r in range(len(texts))], pa.list_(pa.string())),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
    ]


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    most: int = PAIRS,
) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, spans``.

    Words are runs of letters and digits of ASCII, in lower case, and of any other
    character. ``n_hit`` counts the words within an occurrence of a window,
    ``items`` are the ids, as sorted text, of the items whose windows occur, and
    ``spans`` the ranges of hit words, beginning and end in turn, counted from 0.
    Null and empty texts have no words, on both sides. An item without an id marks
    words but is not listed; items of one id are one. Rows keep their number and
    repeated ones are searched each, however long their texts. An empty table of
    documents stays so; an empty benchmark hits nothing. ``keep`` names the columns
    to return, all unless given; columns of the new names are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in FOUND.names]
    blank = F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("text"), *blank)
    schema = StructType([*rows.select("doc", "text").schema, *FOUND])
    pairs = store(benchmark_windows(benchmark, item_id, item_text, window), "windows")

    def run_with(shared: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = shared.value
            for batch in batches:
                for start, end in batches_of(batch.column("text")):
                    part = batch.slice(start, end - start)
                    earlier = part.column("spans").to_pylist(), part.column("items").to_pylist()
                    found = _search(tables, part.column("text"), *earlier)
                    yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text"), *found], names=schema.names)

        return run

    for shared in compile_windows(pairs, most):
        rows = rows.mapInArrow(run_with(shared), schema)
    return rows.select("doc.*", *FOUND.names)
