"""Means, rounding and the ways to the same summary."""

import os
import random
import subprocess
import sys
from decimal import Decimal
from fractions import Fraction

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyfold import (
    apply_per_batch,
    apply_per_chunk,
    chunk_summary,
    group_to_list,
    list_summary,
    mean_of_means,
    merge_lists,
    merge_state,
    number_chunks,
    partial_state,
    round_mean_only,
    station_stats,
    station_summary,
    summarize,
    table_shape,
)
from keyfold.functions.numeric import exact_sum, format_rounded, round_half_even, scaled_integer
from keyfold.operators.apply import BATCH_SCHEMA, SUMMARY_SCHEMA, group_batch, merge_batches, summarize_chunk


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def random_rows():
    pick = random.Random(5)
    rows = []
    for i in range(4000):
        # One station holds a third of the rows.
        station = "hot" if i % 3 == 0 else f"S{pick.randrange(40)}"
        rows.append((i, i // 500, station, pick.randrange(-999, 1000) / 10))
    return rows


@pytest.fixture
def random_table(spark, random_rows):
    return spark.createDataFrame(random_rows, "id BIGINT, chunk BIGINT, station STRING, temp DOUBLE")


def by_hand(rows):
    """Exact rational arithmetic; Python rounds fractions half to even."""
    groups = {}
    for *_, station, temp in rows:
        groups.setdefault(station, []).append(Fraction(str(temp)))
    found = []
    for station, temps in groups.items():
        mean = float(sum(temps)) / len(temps)
        numbers = (min(temps), Fraction(str(mean)), max(temps))
        found.append((station, *(float(round(n * 10)) / 10 for n in numbers)))
    return sorted(found)


def test_summary_matches_exact_arithmetic(random_table, random_rows):
    found = list(map(tuple, station_summary(random_table).collect()))
    assert found == by_hand(random_rows)


def test_all_ways_to_the_summary_agree(random_table):
    wanted = rows_of(station_summary(random_table))
    lists = group_to_list(random_table)
    assert rows_of(merge_state(partial_state(random_table))) == wanted
    assert rows_of(list_summary(lists)) == wanted
    assert rows_of(list_summary(merge_lists(lists, fan_in=3))) == wanted
    assert rows_of(station_summary(random_table.repartition(13))) == wanted
    assert rows_of(station_summary(random_table.orderBy("temp").coalesce(1))) == wanted
    numbered = number_chunks(random_table.drop("chunk"), "id", 64)
    assert rows_of(list_summary(group_to_list(numbered))) == wanted


def test_partial_states_merge_in_steps(random_table):
    states = partial_state(random_table)
    halves = states.withColumn("half", F.col("chunk") % 2)
    stepwise = halves.groupBy("half", "station").agg(
        F.min("t_min").alias("t_min"),
        F.sum("t_sum").alias("t_sum"),
        F.max("t_max").alias("t_max"),
        F.sum("n").alias("n"),
    )
    assert rows_of(merge_state(stepwise)) == rows_of(merge_state(states))


def test_lists_hold_every_value_in_bounded_parts(random_table, random_rows):
    numbered = number_chunks(random_table.drop("chunk"), "id", 64)
    lists = group_to_list(numbered)
    assert lists.agg(F.max(F.size("temps"))).first()[0] <= 64
    merged = merge_lists(lists, fan_in=4)
    assert merged.agg(F.max(F.size("temps"))).first()[0] <= 4 * 64
    for part in (lists, merged):
        values = part.select("station", F.explode("temps")).collect()
        assert sorted(map(tuple, values)) == sorted((r[2], r[3]) for r in random_rows)


def test_mean_of_means_is_unweighted(measurements):
    df = measurements([(0, "A", 10.0), (0, "A", 20.0), (0, "A", 30.0), (1, "A", 0.0)])
    assert station_summary(df).first() == ("A", 0.0, 15.0, 30.0)
    assert mean_of_means(chunk_summary(df)).first() == ("A", 0.0, 10.0, 30.0)


@pytest.mark.parametrize("size", [1.0, 1e20])
def test_plain_doubles_may_be_of_any_size(measurements, size):
    df = measurements([(0, "A", size), (0, "A", 3 * size), (1, "A", 0.0)])
    chunks = chunk_summary(df, scale=None)
    assert mean_of_means(chunks, digits=None, exact=False).first() == ("A", 0.0, size, 3 * size)
    wanted = ("A", 0.0, 4 * size / 3, 3 * size)
    assert station_stats(df, scale=None).first() == wanted
    assert merge_state(partial_state(df, scale=None), digits=None).first() == wanted
    assert list_summary(group_to_list(df), scale=None, digits=None).first() == wanted


def test_mean_of_means_of_equal_chunks_is_the_mean(measurements):
    df = measurements([(0, "A", 10.0), (0, "A", 20.0), (1, "A", 30.0), (1, "A", 40.0)])
    assert station_summary(df).first().t_mean == 25.0
    assert mean_of_means(chunk_summary(df)).first().t_mean == 25.0


def test_station_missing_from_a_chunk(measurements):
    df = measurements([(0, "A", 1.0), (0, "B", 3.0), (1, "B", 5.0)])
    wanted = [("A", 1.0, 1.0, 1.0), ("B", 3.0, 4.0, 5.0)]
    assert rows_of(merge_state(partial_state(df))) == wanted
    assert rows_of(mean_of_means(chunk_summary(df))) == wanted
    assert rows_of(list_summary(group_to_list(df))) == wanted


def test_one_row(measurements):
    assert station_summary(measurements([(0, "A", 5.0)])).first() == ("A", 5.0, 5.0, 5.0)


def test_no_rows(measurements):
    df = measurements([])
    assert station_summary(df).collect() == []
    assert table_shape(station_summary(df)).first() == (0, 4)


@pytest.mark.parametrize("value, wanted", [(0.25, 0.2), (0.35, 0.4), (-0.25, -0.2), (-0.04, 0.0)])
def test_ties_go_to_even(spark, value, wanted):
    assert spark.range(1).select(round_half_even(F.lit(value))).first()[0] == wanted


def test_a_tie_is_one_of_the_scaled_value(measurements):
    # 1476480.60 / 28 is 52731.45, but not so in doubles.
    rows = [(0, "A", 52731.45)] * 26 + [(0, "A", 52731.44), (0, "A", 52731.46)]
    df = measurements(rows)
    assert station_stats(df, scale=2).first().t_mean == 52731.450000000004
    assert station_summary(df, scale=2).first().t_mean == 52731.4


def test_rounding_matches_the_sql_engine(spark):
    pick = random.Random(3)
    values = [pick.randrange(-(10**7), 10**7) / 100 / pick.randrange(1, 60) for _ in range(5000)]
    values += [k / 100 for k in range(-3005, 3006, 10)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    wanted = con.execute(
        "SELECT round_even(v, 1) + 0.0, printf('%.1f', round_even(v, 1)) FROM t ORDER BY i"
    ).fetchall()
    df = spark.createDataFrame(list(enumerate(values)), "i INT, v DOUBLE")
    found = df.orderBy("i").select(round_half_even(F.col("v")), format_rounded(F.col("v"))).collect()
    assert list(map(tuple, found)) == wanted


@pytest.mark.parametrize(
    "value, wanted",
    [(-0.04, "-0.0"), (0.04, "0.0"), (0.0, "0.0"), (-0.05, "-0.0"), (-0.06, "-0.1"), (99.9, "99.9"), (-1.25, "-1.2")],
)
def test_text_keeps_the_sign_of_zero(spark, value, wanted):
    assert spark.range(1).select(format_rounded(F.lit(value))).first()[0] == wanted


def test_mean_only_is_rounded(measurements):
    df = measurements([(0, "A", 1.25), (0, "A", 1.26)])
    assert round_mean_only(df, scale=2).first() == ("A", 1.25, 1.3, 1.26)
    assert station_summary(df, scale=2).first() == ("A", 1.2, 1.3, 1.3)


def test_sorted_by_code_point(measurements):
    df = measurements([(0, name, 1.0) for name in ("b", "A", "É", "Z")])
    assert [r.station for r in station_summary(df).collect()] == ["A", "Z", "b", "É"]


def test_values_with_more_decimals_fail(measurements):
    df = measurements([(0, "A", 1.25)])
    with pytest.raises(Exception, match="does not fit 1 decimals"):
        station_stats(df, scale=1).collect()
    assert station_stats(df, scale=None).first().t_mean == 1.25


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e17])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_are_not_exact_fail(spark, measurements, value, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            station_stats(measurements([(0, "A", value)])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_nulls_are_left_out(measurements):
    df = measurements([(0, "A", 1.0), (0, "A", None), (0, "B", None)])
    assert rows_of(station_stats(df).filter("station = 'A'")) == [("A", 1.0, 1.0, 1.0)]
    assert station_stats(df).filter("station = 'B'").first() == ("B", None, None, None)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=30), st.sampled_from([0, 1, 2, 5]))
def test_exact_sum_is_exact(spark, numbers, scale):
    # Only whole numbers of at most 15 digits have a double for each.
    values = [float(Decimal(n).scaleb(-scale)) for n in numbers]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    found = df.agg(exact_sum(F.col("v"), scale)).first()[0]
    assert found == sum(Decimal(n).scaleb(-scale) for n in numbers)


def test_exact_sum_goes_past_bigint(spark):
    # 2 * 10**6 rows of 9 * 10**15 add up to more than 2**63.
    df = spark.range(2_000_000).select(F.lit(9e15).alias("v"), F.col("id"))
    assert df.agg(exact_sum(F.col("v"), 0)).first()[0] == 2_000_000 * 9 * 10**15
    minus = df.agg(exact_sum(-F.col("v"), 0)).first()[0]
    assert minus == -2_000_000 * 9 * 10**15


def test_scaled_integer(spark):
    df = spark.createDataFrame([(12.3,), (-99.9,), (0.0,), (None,)], "v DOUBLE")
    assert [r[0] for r in df.select(scaled_integer(F.col("v"), 1)).collect()] == [123, -999, 0, None]


def test_summarize_takes_names_and_functions(measurements):
    df = measurements([(0, "A", 1.0), (1, "A", 3.0)])
    specs = [("temp", "min", "low"), ("temp", F.max, "high"), ("chunk", lambda c: F.count_distinct(c), "chunks")]
    found = summarize(df, "station", specs)
    assert found.columns == ["station", "low", "high", "chunks"]
    assert found.first() == ("A", 1.0, 3.0, 2)
    assert summarize(df, ["chunk", "station"], specs[:1]).count() == 2


def test_function_on_chunks(spark, random_table):
    rows = random_table.select("chunk", "station", "temp")
    wanted = rows_of(
        rows.groupBy("chunk", "station").agg(F.min("temp"), F.max("temp"), F.count("temp"))
    )
    # Batches far smaller than a chunk of the data.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = rows_of(merge_batches(apply_per_batch(rows, group_batch, BATCH_SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == wanted


@pytest.mark.parametrize("size", [100, 10_000])
def test_function_on_whole_chunks(spark, random_table, size):
    rows = random_table.select("chunk", "station", "temp")
    rows = rows.unionByName(spark.createDataFrame([(1, None, 2.5), (1, None, 3.5), (None, "A", 1.0)], rows.schema))
    wanted = sorted(map(tuple, chunk_summary(rows, scale=1).collect()), key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        found = apply_per_chunk(rows, summarize_chunk(1), SUMMARY_SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found), key=repr) == wanted


def test_null_stations_stay_in_batches(spark, measurements):
    rows = measurements([(0, None, 1.0), (0, None, 2.0), (0, "A", 3.0)])
    found = merge_batches(apply_per_batch(rows, group_batch, BATCH_SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(0, None, 1.0, 2.0, 2), (0, "A", 3.0, 3.0, 1)], key=repr)


def test_long_lists_are_split(measurements):
    rows = [(0, "hot", 1.5)] * 900 + [(0, f"S{i}", float(i)) for i in range(40)] + [(None, None, 2.0)] * 200
    lists = group_to_list(measurements(rows).repartition(3), most=100)
    sizes = lists.select("station", F.size("temps").alias("n")).collect()
    assert max(r.n for r in sizes) <= 100
    assert sum(r.n for r in sizes) == len(rows)
    assert sum(r.n for r in sizes if r.station == "hot") == 900
    assert list_summary(lists).count() == 42


def test_negative_row_numbers_make_no_double_chunk(spark):
    df = spark.range(-20, 20).withColumn("station", F.lit("A"))
    sizes = number_chunks(df, "id", 4).groupBy("chunk").count().collect()
    assert {r["count"] for r in sizes} == {4}


def test_list_sums_do_not_overflow(spark):
    big = float(2**52)
    df = spark.createDataFrame([("A", [big] * 5000)], "station STRING, temps ARRAY<DOUBLE>")
    assert list_summary(df, scale=0, digits=None).first().t_mean == big


def test_bounded_lists_depend_on_the_data_alone(measurements, spark):
    """However rows are ordered and dealt to tasks, each value is in the same list."""
    rows = [(0, "hot", float(i % 37)) for i in range(3000)] + [(0, "hot", 1.5)] * 2000 + [(1, None, None), (1, "B", 2.0)]
    df = measurements(rows)
    ways = [df.repartition(1), df.repartition(5, "temp"), df.orderBy(F.desc("temp")), df.repartition(11)]
    lists = [sorted(map(repr, group_to_list(w, most=100).collect())) for w in ways]
    assert lists[0] == lists[1] == lists[2] == lists[3]
    whole = group_to_list(df, most=100)
    assert whole.agg(F.sum(F.size("temps"))).first()[0] == len(rows) - 1
    assert whole.agg(F.max(F.size("temps"))).first()[0] <= 100


def test_bounded_lists_survive_a_lost_shuffle_file(spark, tmp_path):
    """A task that is run again deals its rows as before: nothing is lost or doubled."""
    script = tmp_path / "lost.py"
    script.write_text(
        """
import glob, os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from keyfold.operators.lists import group_to_list
local = sys.argv[2]
spark = (SparkSession.builder.master("local[2,4]").config("spark.local.dir", local).config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.enabled", "false").getOrCreate())
df = spark.range(20000).select(F.lit(0).alias("chunk"), F.lit("hot").alias("station"), (F.col("id") % 613).cast("double").alias("temp"))
lists = group_to_list(df.repartition(3), most=500)
rdd = lists.rdd.map(lambda r: (len(r.temps), sum(r.temps)))
first = sorted(rdd.collect())
lost = glob.glob(local + "/**/shuffle_*.data", recursive=True)
assert lost
for path in lost:
    os.remove(path)
assert sorted(rdd.collect()) == first
assert sum(n for n, _ in first) == 20000 and max(n for n, _ in first) <= 500
print("SAME")
"""
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    local = str(tmp_path / "local")
    run = [sys.executable, str(script), root, local]
    got = subprocess.run(run, capture_output=True, text=True, timeout=240, env=os.environ | {"SPARK_LOCAL_DIRS": local})
    assert "SAME" in got.stdout, got.stderr[-2000:]
