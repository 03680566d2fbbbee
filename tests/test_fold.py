"""Aggregates in Python whose states merge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.operators import fold

from plan_metrics import rows_shuffled

ROWS = "station STRING, part INT, temp DOUBLE"


def longest_text():
    """A fold of one's own, with a state of another type than its rows."""

    class First(fold.Fold):
        state = result = "longest STRING, n BIGINT"

        def zero(self):
            return None, 0

        def update(self, state, rows):
            texts = [t for t in rows.column(0).to_pylist() if t is not None]
            return self.merge(state, (max(texts, key=lambda t: (len(t), t), default=None), len(rows)))

        def merge(self, one, other):
            texts = [t for t in (one[0], other[0]) if t is not None]
            return max(texts, key=lambda t: (len(t), t), default=None), one[1] + other[1]

        def finish(self, state):
            return state

    return First()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    made = [(f"s{rng.integers(20)}" if i % 11 else None, int(rng.integers(3)), float(rng.integers(-999, 999)) / 10) for i in range(5000)]
    made += [("empty", 0, None), ("one", None, 2.5), ("zero", 1, -0.0)]
    return spark.createDataFrame(made, ROWS).repartition(7)


@pytest.mark.parametrize("most", [1 << 16, 1, 7])
def test_mean_and_variance_equal_built_ins(spark, rows, most):
    """However often a task passes its states on."""
    keys = ["station", "part"]
    found = {(r.station, r.part): r for r in fold.fold_by_key(rows, keys, "temp", fold.MeanVariance(1), most).collect()}
    wanted = rows.groupBy(*keys).agg(F.count("temp").alias("n"), F.avg("temp").alias("mean"), F.var_pop("temp").alias("variance"))
    wanted = wanted.collect()
    assert len(found) == len(wanted)
    for row in wanted:
        got = found[row.station, row.part]
        assert got.n == row.n
        assert (got.mean, got.variance) == (pytest.approx(row["mean"], abs=1e-9), pytest.approx(row.variance, abs=1e-9)) or row.n == 0


def test_result_does_not_depend_on_the_split(rows):
    ways = [rows, rows.coalesce(1), rows.repartition(23)]
    results = [sorted(map(tuple, fold.fold_by_key(w, "part", "temp", fold.MeanVariance(1)).collect()), key=repr) for w in ways]
    assert results[0] == results[1] == results[2]


def test_a_hot_station_adds_one_state_a_task(spark):
    hot = spark.range(0, 200_000, numPartitions=6).select(F.lit("hot").alias("station"), (F.col("id") % 10 / 10).alias("temp"))
    found = fold.fold_by_key(hot, "station", "temp", fold.MeanVariance(1))
    assert rows_shuffled(found) == [6]
    assert found.first().n == 200_000


def test_extremes(spark, rows):
    found = {r.station: r for r in fold.fold_by_key(rows, "station", "temp", fold.Extremes()).collect()}
    for row in rows.groupBy("station").agg(F.min("temp").alias("low"), F.max("temp").alias("high")).collect():
        got = found[row.station]
        assert (got.low, got.high) == (row.low, row.high)
        if row.low is not None:
            same = rows.filter(F.col("station").eqNullSafe(row.station))
            assert got.n_low == same.filter(F.col("temp") == row.low).count()
            assert got.n_high == same.filter(F.col("temp") == row.high).count()
    assert found["empty"].low is None and found["empty"].n_high == 0


def test_own_fold_over_text(spark):
    texts = spark.createDataFrame([(1, "a"), (1, "ccc"), (1, "bbb"), (2, None), (None, "x")], "k INT, t STRING").repartition(3)
    found = sorted(map(tuple, fold.fold_by_key(texts, "k", "t", longest_text()).collect()), key=repr)
    assert found == [(1, "ccc", 3), (2, None, 1), (None, "x", 1)]


def test_states_merge_later(rows):
    """States of two halves, kept apart at first."""
    one, other = (fold.partial_fold(rows.filter(f"coalesce(temp, 0) {sign} 0"), ["part"], ["temp"], fold.MeanVariance(1)) for sign in ("<", ">="))
    merged = fold.merge_fold(one.unionByName(other), ["part"], fold.MeanVariance(1))
    whole = fold.fold_by_key(rows, "part", "temp", fold.MeanVariance(1))
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_large_values_and_bad_ones(spark):
    df = spark.createDataFrame([("a", 1e11), ("a", 2e11), ("a", 3e11)], "station STRING, temp DOUBLE")
    row = fold.fold_by_key(df, "station", "temp", fold.MeanVariance(2)).first()
    assert (row.n, row["mean"]) == (3, 2e11) and row.variance == pytest.approx(2e22 / 3)
    for bad in (0.123, float("nan"), float("inf")):
        with pytest.raises(Exception, match="decimals"):
            fold.fold_by_key(spark.createDataFrame([("a", bad)], "station STRING, temp DOUBLE"), "station", "temp", fold.MeanVariance(2)).collect()


def test_empty_table(rows):
    assert fold.fold_by_key(rows.limit(0), "station", "temp", fold.Extremes()).collect() == []


@pytest.mark.parametrize("made", [fold.MeanVariance(1), fold.Extremes()])
def test_many_keys_of_few_rows_cost_no_call_each(spark, monkeypatch, made):
    """Batches of rows and of states are treated as a whole, with the results of going key by key."""
    values = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 9 = 0 THEN -id ELSE id END / 10D"
    df = spark.range(0, 60_000, numPartitions=3).selectExpr("CAST(id * 31 % 20000 AS STRING) AS k", "id % 2 AS half", f"{values} AS temp")
    slow = {tuple(r) for r in fold.fold_by_key(df, ["k", "half"], "temp", changed(made, update_each=fold.Fold.update_each, merge_each=fold.Fold.merge_each)).collect()}

    def refuse(self, *_):
        raise AssertionError("one call a key")

    fast = changed(made, update=refuse, merge=refuse)
    found = [tuple(r) for r in fold.fold_by_key(df, ["k", "half"], "temp", fast).collect()]
    assert len(found) == 20_000 and set(found) == slow


def changed(made, **methods):
    """A fold of the same parameters with other methods."""
    kind = type("Changed", (type(made),), methods)
    copy = kind.__new__(kind)
    copy.__dict__.update(made.__dict__)
    return copy


def test_sums_beyond_64_bits_and_small_ones_side_by_side(spark):
    rows = [("a", 2e7), ("a", -1e7), ("b", 4e13), ("b", 4e13), ("c", None), ("d", -0.01)]
    df = spark.createDataFrame(rows * 3, "station STRING, temp DOUBLE").repartition(2)
    found = {r.station: (r.n, r["mean"], r.variance) for r in fold.fold_by_key(df, "station", "temp", fold.MeanVariance(2)).collect()}
    assert found == {"a": (6, 5e6, 2.25e14), "b": (6, 4e13, 0.0), "c": (0, None, None), "d": (3, -0.01, 0.0)}
