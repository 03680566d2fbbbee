"""Joins on the station, row numbers, maps and text."""

import random

import pytest
from pyspark.sql import functions as F

from keyfold import (
    chunk_mean_report,
    chunk_summary,
    distinct_stations,
    drop_stations,
    filter_station,
    group_to_list,
    join_on_station,
    keep_stations,
    keys_join_partials,
    list_state,
    lookup,
    map_rows,
    partial_state,
    report_lines,
    report_string,
    scan_lines,
    station_report,
    station_stats,
    station_summary,
    summary_map,
    union_distinct_stations,
    union_tables,
    write_report_lines,
)
from keyfold.operators import keys
from keyfold.operators.keys import station_salts
from keyfold.operators.numbering import number_rows

BOTH_WAYS = [
    {},
    {"broadcast_bytes": 0, "rows_per_task": 50, "salts": 5},
    {"broadcast_bytes": 0, "rows_per_task": 50, "salts": 3, "salt_on": "chunk"},
    {"broadcast_bytes": 0, "rows_per_task": 7},
]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def skewed(measurements):
    # One station has most rows, many of them equal.
    rows = [(i % 4, "hot", float(i % 2)) for i in range(300)]
    return measurements(rows + [(i % 4, f"S{i % 20}", float(i)) for i in range(100)])


@pytest.fixture
def wanted_keys(spark):
    names = ["hot", "hot", "S3", "S4", "absent"]
    return spark.createDataFrame([(n,) for n in names], "station STRING")


@pytest.mark.parametrize("how", BOTH_WAYS)
def test_semi_and_anti_split_the_table(skewed, wanted_keys, how):
    names = {r.station for r in wanted_keys.collect()}
    everything = rows_of(skewed)
    kept = rows_of(keep_stations(skewed, wanted_keys, **how).select(*skewed.columns))
    dropped = rows_of(drop_stations(skewed, wanted_keys, **how).select(*skewed.columns))
    assert kept == [r for r in everything if r[1] in names]
    assert dropped == [r for r in everything if r[1] not in names]


@pytest.mark.parametrize("how", BOTH_WAYS)
def test_anti_join_on_no_keys(skewed, wanted_keys, how):
    nothing = wanted_keys.filter("station = 'nowhere'")
    assert drop_stations(skewed, nothing, **how).count() == skewed.count()
    assert keep_stations(skewed, nothing, **how).count() == 0


@pytest.mark.parametrize("how", BOTH_WAYS)
def test_keys_join_partials(skewed, wanted_keys, how):
    states = partial_state(skewed, scale=1)
    found = keys_join_partials(wanted_keys, states, **how).select(*states.columns)
    assert rows_of(found) == rows_of(states.filter(F.col("station").isin("hot", "S3", "S4")))


@pytest.mark.parametrize("how", BOTH_WAYS[:2])
def test_lookup_is_sorted(skewed, wanted_keys, how):
    result = station_summary(skewed)
    found = lookup(wanted_keys, result, **how)
    assert [r.station for r in found.collect()] == ["S3", "S4", "hot"]


def test_the_size_decides_on_a_broadcast(skewed, wanted_keys):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    names = wanted_keys.distinct()
    assert "BroadcastHashJoin" in plan(join_on_station(skewed, names))
    salted = plan(join_on_station(skewed, names, broadcast_bytes=0))
    assert "hashpartitioning(station" in salted or "BroadcastHashJoin" in salted
    assert "_salt" in salted


def test_a_hot_station_is_spread_over_the_salts(spark, skewed):
    names = distinct_stations(skewed)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_on_station(skewed.coalesce(1), names, "left_semi", broadcast_bytes=0, rows_per_task=20)
        per_task = (
            joined.filter("station = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in per_task) == 300
    assert len(per_task) > 1


def test_salts_follow_the_rows(measurements):
    rows = [(0, f"S{i % 50}", 1.0) for i in range(500)] + [(0, "hot", 1.0)] * 400 + [(0, None, 1.0)] * 900
    df = measurements(rows)
    assert rows_of(station_salts(df, rows_per_task=100)) == [("hot", 4)]
    assert rows_of(station_salts(df, rows_per_task=399)) == [("hot", 2)]
    assert station_salts(df, rows_per_task=400).count() == 0
    assert station_salts(df.limit(0)).count() == 0


def test_salts_from_a_sample(spark, monkeypatch):
    monkeypatch.setattr(keys, "COUNTED_BYTES", 200_000)
    df = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("station"))
    (row,) = station_salts(df, rows_per_task=20_000).collect()
    assert row.station == "hot" and 8 <= row._salts <= 12


JOIN_TYPES = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_the_size_does_not_change_the_rows(spark, how):
    rng = random.Random(JOIN_TYPES.index(how))
    for _ in range(2):
        names = [None, "hot", "warm", *[f"S{i}" for i in range(12)]]
        rows = [(i, rng.choices(names, [3, 40, 9, *[1] * 12])[0]) for i in range(rng.randint(0, 200))]
        df = spark.createDataFrame(rows, "id BIGINT, station STRING")
        keyed = spark.createDataFrame(
            [(n, f"k{n}") for n in [*rng.sample(names, 9), "only here", "nor there"]], "station STRING, about STRING"
        )
        wanted = df.join(keyed, "station", how)
        for way in ({}, {"broadcast_bytes": 0, "rows_per_task": 5}, {"broadcast_bytes": 0, "rows_per_task": 5, "salts": 3}):
            found = join_on_station(df, keyed, how, **way).select(*wanted.columns)
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


def test_unknown_join_type(skewed, wanted_keys):
    with pytest.raises(ValueError, match="cross"):
        join_on_station(skewed, wanted_keys, "cross")


def test_sets_of_stations(measurements):
    one = measurements([(0, "A", 1.0), (0, "A", 1.0), (0, "B", 2.0)])
    two = measurements([(1, "B", 3.0), (1, "C", 4.0)])
    assert rows_of(distinct_stations(one)) == [("A",), ("B",)]
    assert rows_of(union_distinct_stations([one, two])) == [("A",), ("B",), ("C",)]
    assert union_tables([one, two, one]).count() == 8
    assert rows_of(filter_station(one, "A")) == [(0, "A", 1.0), (0, "A", 1.0)]


@pytest.fixture
def many(measurements):
    return measurements([(0, f"S{i:03d}", float(i)) for i in range(97)])


def test_row_numbers_are_consecutive(spark, many):
    shuffled = many.repartition(7)
    numbered, total = number_rows(shuffled, "station")
    found = numbered.orderBy("row_no").collect()
    assert total == 97
    assert [r.row_no for r in found] == list(range(97))
    assert [r.station for r in found] == [f"S{i:03d}" for i in range(97)]


@pytest.mark.parametrize("lines_per_part", [1, 10, 96, 97, 1000])
@pytest.mark.parametrize("trailing_sep", [True, False])
def test_report_parts_add_up(many, lines_per_part, trailing_sep):
    stats = station_stats(many)
    lines = [f"S{i:03d}={i}.0/{i}.0/{i}.0" for i in range(97)]
    wanted = "{" + ", ".join(lines) + (", }" if trailing_sep else "}")
    parts = report_string(stats, trailing_sep=trailing_sep, lines_per_part=lines_per_part).collect()
    assert [p.part for p in parts] == list(range(-(-97 // lines_per_part)))
    assert "".join(p.report for p in parts) == wanted


def test_report_of_nothing(measurements):
    assert report_string(station_stats(measurements([]))).collect() == [(0, "{}")]


def test_negative_zero_in_the_report(measurements):
    df = measurements([(0, "Tromsø", -99.9), (0, "Tromsø", 99.8), (0, "Tromsø", 0.0)])
    assert report_lines(station_stats(df)).first().line == "Tromsø=-99.9/-0.0/99.8"
    assert station_summary(df).first().t_mean == 0.0


def test_written_lines_are_in_order(spark, many, tmp_path):
    path = tmp_path / "lines"
    write_report_lines(station_stats(many.repartition(5)), str(path))
    text = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert text.splitlines() == [f"S{i:03d}={i}.0/{i}.0/{i}.0" for i in range(97)]


@pytest.mark.parametrize("entries", [1, 10, 1000])
def test_maps_hold_every_station(many, entries):
    stats = station_stats(many)
    maps = summary_map(stats, entries_per_map=entries)
    assert maps.count() == -(-97 // entries)
    assert maps.agg(F.max(F.size("summary"))).first()[0] <= entries
    assert rows_of(map_rows(maps)) == rows_of(station_summary(many))


def test_reports_from_text(spark, text_file):
    path = text_file("Zürich;12.3\nÅre;-5.0\nZürich;-0.1\n")
    wanted = "{Zürich=-0.1/6.1/12.3, Åre=-5.0/-5.0/-5.0, }"
    assert station_report(spark, path, trailing_sep=True).first().report == wanted
    one_chunk = chunk_mean_report(spark, path, num_chunks=1, trailing_sep=True)
    assert one_chunk.first().report == wanted


def test_report_of_chunk_means(spark, text_file, tmp_path):
    text_file("A;10.0\nA;20.0\nA;30.0\n", "one.txt")
    text_file("A;0.0\n", "two.txt")
    report = chunk_mean_report(spark, str(tmp_path), num_chunks=1)
    # Two files are at least two splits.
    assert report.first().report in ("{A=0.0/10.0/30.0}", "{A=0.0/15.0/30.0}")
    assert station_report(spark, str(tmp_path)).first().report == "{A=0.0/15.0/30.0}"


def test_a_station_without_a_name_is_not_reported(spark, measurements):
    stats = station_stats(measurements([(0, None, 1.0), (0, "A", 2.0)]))
    for made in (report_lines(stats), report_string, summary_map):
        with pytest.raises(Exception, match="without a name"):
            (made(stats) if callable(made) else made).collect()


def test_only_the_mean_is_rounded(measurements):
    stats = station_stats(measurements([(0, "A", 1.25), (0, "A", 1.26)]), scale=2)
    assert report_lines(stats, columns=["t_mean"]).first().line == "A=1.25/1.3/1.26"
    assert report_lines(stats).first().line == "A=1.2/1.3/1.3"


@pytest.mark.parametrize("order", [(0.0, -0.0), (-0.0, 0.0)])
def test_the_sign_of_zero_does_not_depend_on_order(measurements, order):
    df = measurements([(0, "A", v) for v in order]).coalesce(1)
    assert report_lines(station_stats(df)).first().line == "A=0.0/0.0/0.0"
    assert str(chunk_summary(df).first().temp_minimum) == "0.0"
    assert str(partial_state(df).first().t_min) == "0.0"
    assert str(list_state(group_to_list(df)).first().t_max) == "0.0"


def test_equal_rows_of_a_hot_station_are_spread(spark):
    """A million equal rows, and others, over 16 salts: each gets its share, and few rows are shuffled."""
    equal = spark.range(1_000_000).select(F.lit("hot").alias("station"), F.lit(1.5).alias("temp"))
    other = spark.range(50_000).select(F.lit("hot").alias("station"), (F.col("id") + 0.5).alias("temp"))
    df = equal.union(other).union(spark.createDataFrame([(None, 1.5), ("cold", 1.5)], "station STRING, temp DOUBLE"))
    hot = station_salts(df, 100_000, 16)
    salted = keys.salted_rows(df, hot, 100_000)
    sizes = salted.filter("station = 'hot'").groupBy("_salt").agg(F.sum("_copies").alias("n"), F.count("*").alias("rows")).collect()
    assert len(sizes) == 16 and sum(r.n for r in sizes) == 1_050_000
    assert max(r.n for r in sizes) < 2 * min(r.n for r in sizes)
    assert sum(r["rows"] for r in sizes) <= 50_000 + 16
    names = spark.createDataFrame([("hot", 1), ("absent", 2)], "station STRING, code INT")
    for how, n in (("inner", 1_050_000), ("left", 1_050_002), ("left_semi", 1_050_000), ("left_anti", 2), ("full", 1_050_003)):
        joined = keys.join_on_station(df, names, how, broadcast_bytes=0, rows_per_task=100_000, salts=16)
        assert "_copies" not in joined.columns and joined.count() == n
