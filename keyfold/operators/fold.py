"""Aggregates written in Python whose partial results merge.

A fold says what an empty state is, how rows change it, how two states become one
and what comes of it. Each task keeps one state per key, so a key with a third of
all rows adds one row per task to the one shuffle. States of a key then stand side
by side and are merged as they are read; no task holds all rows or all states of
a key. States are columns, and a fold may treat all keys of a batch at once, so many
keys of a few rows each cost no call each.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Keys that a task holds before it passes their states on; a key may have several.
STATES = 1 << 16


class Fold(ABC):
    """An aggregate over the rows of a key, whose states are tuples."""

    #: Columns of a state and of the result, as in ``CREATE TABLE``.
    state: str
    result: str

    @abstractmethod
    def zero(self) -> tuple:
        """The state of no rows."""

    @abstractmethod
    def update(self, state: tuple, rows: pa.RecordBatch) -> tuple:
        """The state with the rows of one key added; they have the columns asked for."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple:
        """The state of the rows of both, whichever comes first."""

    @abstractmethod
    def finish(self, state: tuple) -> tuple:
        """The columns of the result."""

    def update_each(self, rows: pa.RecordBatch, starts: np.ndarray) -> list:
        """The columns of the states of groups of rows, which begin at ``starts``.

        This and ``merge_each`` go key by key; a fold over many keys overrides them.
        """
        ends = [*starts[1:], rows.num_rows]
        return _columns([self.update(self.zero(), rows.slice(a, b - a)) for a, b in zip(starts, ends, strict=True)])

    def merge_each(self, states: pa.RecordBatch, starts: np.ndarray) -> list:
        """The columns of the states that groups of states, which begin at ``starts``, become."""
        each = list(zip(*[c.to_pylist() for c in states.columns], strict=True))
        return _columns([reduce(self.merge, each[a:b]) for a, b in zip(starts, [*starts[1:], len(each)], strict=True)])


def _columns(rows: Sequence[tuple]) -> list:
    return list(zip(*rows, strict=True))


def _codes(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """A number for the values of the first columns of each row; NULL is a value too."""
    code = np.zeros(batch.num_rows, np.int64)
    for i in range(keys):
        coded = pc.dictionary_encode(batch.column(i), null_encoding="encode")
        code = code * len(coded.dictionary) + coded.indices.to_numpy()
        if keys > 1:
            # Renumbered, so that numbers of several keys together stay small.
            code = np.unique(code, return_inverse=True)[1]
    return code


def _starts(code: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(code, prepend=-1))


def _grouped(batch: pa.RecordBatch, keys: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows, those of one key side by side, and where keys begin."""
    code = _codes(batch, keys)
    order = np.argsort(code, kind="stable")
    return batch.take(pa.array(order)), _starts(code[order])


def _split(batch: pa.RecordBatch, keys: int, starts: np.ndarray) -> tuple[list[pa.Array], pa.RecordBatch]:
    """The columns of the keys, once for each group, and the other columns of all rows."""
    once = batch.select(list(range(keys))).take(pa.array(starts))
    return once.columns, batch.select(list(range(keys, batch.num_columns)))


def _batch(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(list(c), f.type) for c, f in zip(columns or [()] * len(schema), schema, strict=True)]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def _joined(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    columns = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batches[0].schema)


def partial_fold(df: DataFrame, keys: Sequence[str], columns: Sequence[str], fold: Fold, most: int = STATES) -> DataFrame:
    """``keys`` and the state's columns: the states of each task, for ``merge_fold`` now or later."""
    chosen = df.select(*[F.col(f"`{c}`") for c in (*keys, *columns)])
    schema, n = StructType([*chosen.schema[: len(keys)], *StructType.fromDDL(fold.state)]), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, held, rows = to_arrow_schema(schema), [], 0

        def merged() -> pa.RecordBatch:
            states, starts = _grouped(_joined(held), n)
            if len(starts) == states.num_rows:
                return states
            values, rest = _split(states, n, starts)
            return _batch([*values, *fold.merge_each(rest, starts)], arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            grouped, starts = _grouped(batch, n)
            values, rest = _split(grouped, n, starts)
            held.append(_batch([*values, *fold.update_each(rest, starts)], arrow))
            rows += len(starts)
            if rows >= most:
                states = merged()
                if 2 * states.num_rows >= most:
                    yield states
                    states = states.slice(0, 0)
                held, rows = [states], states.num_rows
        if rows:
            yield merged()

    return chosen.mapInArrow(run, schema)


def merge_fold(states: DataFrame, keys: Sequence[str], fold: Fold) -> DataFrame:
    """``keys`` and the result's columns, from states of any origin."""
    n = len(keys)
    schema = StructType([*states.select(*keys).schema, *StructType.fromDDL(fold.result)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, last = to_arrow_schema(schema), None

        def finished(done: pa.RecordBatch) -> pa.RecordBatch:
            rest = zip(*[c.to_pylist() for c in done.columns[n:]], strict=True)
            return _batch([*done.columns[:n], *_columns([fold.finish(state) for state in rest])], arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last key of a batch may go on in the next.
            whole = batch if last is None else _joined([last, batch])
            starts = _starts(_codes(whole, n))
            if len(starts) < whole.num_rows:
                values, rest = _split(whole, n, starts)
                whole = _batch([*values, *fold.merge_each(rest, starts)], batch.schema)
            last = whole.slice(whole.num_rows - 1)
            if whole.num_rows > 1:
                yield finished(whole.slice(0, whole.num_rows - 1))
        if last is not None:
            yield finished(last)

    side_by_side = states.repartition(*keys).sortWithinPartitions(*keys)
    return side_by_side.mapInArrow(run, schema)


def fold_by_key(df: DataFrame, keys: str | Sequence[str], columns: str | Sequence[str], fold: Fold, most: int = STATES) -> DataFrame:
    """``fold`` over the rows of each key; it sees ``columns`` of ``df`` in that order.

    Keys may be of any type but floating numbers, arrays, maps and structs. NULL is
    a key. ``fold`` is sent to the workers, so it holds no more than parameters.
    """
    keys, columns = ([x] if isinstance(x, str) else list(x) for x in (keys, columns))
    return merge_fold(partial_fold(df, keys, columns, fold, most), keys, fold)


class MeanVariance(Fold):
    """Count, mean and variance of the whole population, from exact sums at ``scale`` decimals.

    NULL is left out. Without any value, mean and variance are NULL. A value that is
    not finite, or has more decimals, fails the job.
    """

    state = "n BIGINT, total DECIMAL(38,0), squares DECIMAL(38,0)"
    result = "n BIGINT, mean DOUBLE, variance DOUBLE"

    def __init__(self, scale: int):
        self.scale = scale

    def zero(self):
        return 0, 0, 0

    def _check(self, values, whole):
        # What a double is off by, some units of its last place.
        if not (np.abs(values - whole) <= 1e-6 + 4e-16 * np.abs(values)).all():
            raise ValueError(f"values must be finite and have at most {self.scale} decimals")

    def update(self, state, rows):
        values = rows.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.float64) * 10**self.scale
        whole = np.rint(values)
        self._check(values, whole)
        if np.abs(whole).max(initial=0) < 1 << 31:
            whole = whole.astype(np.int64)
            square = whole * whole
            total = int(whole.sum())
            squares = (int((square >> 32).sum()) << 32) + int((square & 0xFFFFFFFF).sum())
        else:
            exact = [int(x) for x in whole]
            total, squares = sum(exact), sum(x * x for x in exact)
        return self.merge(state, (len(values), total, squares))

    def update_each(self, rows, starts):
        given = rows.column(0)
        valid = given.is_valid().to_numpy(zero_copy_only=False)
        values = given.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) * 10**self.scale
        whole = np.rint(values)
        if not (np.abs(whole) < 1 << 31).all():
            # Exact integers, or the error, one key at a time.
            return super().update_each(rows, starts)
        self._check(values, whole)
        whole = whole.astype(np.int64)
        square = whole * whole
        added = lambda x: pa.array(np.add.reduceat(x, starts)).cast(pa.decimal128(19))
        high, low = added(square >> 32), added(square & 0xFFFFFFFF)
        squares = pc.add(pc.multiply(high, pa.scalar(1 << 32, pa.decimal128(10))), low)
        return [pa.array(np.add.reduceat(valid.astype(np.int64), starts)), added(whole), squares]

    def merge_each(self, states, starts):
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, states.num_rows]))
        sizes = [np.add.reduceat(np.abs(c.cast(pa.float64()).to_numpy()), starts).max() for c in states.columns[1:]]
        if max(sizes) >= 1e37:
            return super().merge_each(states, starts)
        table = pa.table([pa.array(group), *states.columns], names=["group", "n", "total", "squares"])
        added = table.group_by("group", use_threads=False).aggregate([(c, "sum") for c in table.column_names[1:]])
        return [added.column(f"{c}_sum").combine_chunks() for c in table.column_names[1:]]

    def merge(self, one, other):
        return tuple(int(x) + int(y) for x, y in zip(one, other, strict=True))

    def finish(self, state):
        n, total, squares = map(int, state)
        if not n:
            return 0, None, None
        unit = 10**self.scale
        return n, total / unit / n, float(n * squares - total * total) / float((n * unit) ** 2)


class Extremes(Fold):
    """Least and greatest value, and how many rows have them. NULL is left out."""

    state = "low DOUBLE, n_low BIGINT, high DOUBLE, n_high BIGINT"
    result = state

    def zero(self):
        return None, 0, None, 0

    def update(self, state, rows):
        values = rows.column(0).drop_null().to_numpy(zero_copy_only=False) + 0.0
        if not len(values):
            return state
        low, high = float(values.min()), float(values.max())
        return self.merge(state, (low, int((values == low).sum()), high, int((values == high).sum())))

    def update_each(self, rows, starts):
        values, once = rows.column(0), np.ones(rows.num_rows, np.int64)
        return [*_ends(values, once, starts, np.minimum, np.inf), *_ends(values, once, starts, np.maximum, -np.inf)]

    def merge_each(self, states, starts):
        low, n_low, high, n_high = states.columns
        least = _ends(low, n_low.to_numpy(), starts, np.minimum, np.inf)
        return [*least, *_ends(high, n_high.to_numpy(), starts, np.maximum, -np.inf)]

    def merge(self, one, other):
        return (*_pick(one[:2], other[:2], min), *_pick(one[2:], other[2:], max))

    def finish(self, state):
        return state


def _ends(values: pa.Array, times: np.ndarray, starts: np.ndarray, choose: np.ufunc, none: float) -> tuple[pa.Array, pa.Array]:
    """The least or greatest value of each group, NULL without any, and how often it occurs."""
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    filled = np.where(valid, values.fill_null(0).to_numpy(zero_copy_only=False) + 0.0, none)
    best = choose.reduceat(filled, starts)
    same = valid & (filled == np.repeat(best, np.diff([*starts, len(filled)])))
    return pa.array(best, mask=~np.logical_or.reduceat(valid, starts)), pa.array(np.add.reduceat(np.where(same, times, 0), starts))


def _pick(one: tuple, other: tuple, choose) -> tuple:
    """The better of two values with how often it occurs."""
    if one[0] is None or other[0] is None:
        return one if other[0] is None else other
    best = choose(one[0], other[0])
    return best, (one[1] if one[0] == best else 0) + (other[1] if other[0] == best else 0)
