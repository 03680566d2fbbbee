"""Scans of hand-made files: what is read, and what fails."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keyfold import (
    build_schema,
    merge_state,
    parse_lines,
    partial_state,
    preview,
    rejected_lines,
    scan_chunks,
    scan_delimited,
    scan_late_cast,
    scan_lines,
    station_summary,
    write_lines,
)
from keyfold.sources.delimited import input_bytes, session_for_chunks

SCANS = [scan_delimited, scan_lines, scan_late_cast]

GOOD = {
    "multi-byte, mixed line ends": (
        "Zürich;12.3\nÅre;-5.0\r\nZürich;-0.1\n",
        [("Zürich", -0.1), ("Zürich", 12.3), ("Åre", -5.0)],
    ),
    "no final newline": ("A;1.0\nB;2.0", [("A", 1.0), ("B", 2.0)]),
    "blank line": ("A;1.0\n\nB;2.0\n", [("A", 1.0), ("B", 2.0)]),
    "stray quotes": (
        '"A";1.0\n"B;2.0\nC;3.0\n',
        [('"A"', 1.0), ('"B', 2.0), ("C", 3.0)],
    ),
    "empty file": ("", []),
    "empty name": (";1.0\n", [("", 1.0)]),
    "spaces in a name": ("New York;1.5\n", [("New York", 1.5)]),
}

BAD = {
    "bad number": "A;1.0\nB;x\n",
    "extra field": "A;1.0\nB;2.0;3\n",
    "short row": "A;1.0\nB\n",
    "empty value": "A;1.0\nB;\n",
    "NaN": "A;NaN\nA;1.0\n",
    "infinite": "A;Infinity\nA;1.0\n",
    "too large": "A;1e999\nA;1.0\n",
}


@pytest.mark.parametrize("scan", SCANS)
@pytest.mark.parametrize("case", GOOD)
def test_good_rows(spark, text_file, scan, case):
    content, wanted = GOOD[case]
    assert sorted(map(tuple, scan(spark, text_file(content)).collect())) == wanted


@pytest.mark.parametrize("scan", SCANS)
@pytest.mark.parametrize("case", BAD)
@pytest.mark.parametrize("read", ["all", "station", "count"])
def test_bad_rows_fail_whatever_is_read(spark, text_file, scan, case, read):
    df = scan(spark, text_file(BAD[case]))
    with pytest.raises(Exception):
        if read == "count":
            df.count()
        elif read == "station":
            df.select("station").collect()
        else:
            df.collect()


@pytest.mark.parametrize("scan", [scan_lines, scan_late_cast])
@pytest.mark.parametrize("suffix", "dDfF")
def test_type_suffix_is_not_a_number(spark, text_file, scan, suffix):
    with pytest.raises(Exception, match="bad row"):
        scan(spark, text_file(f"A;1.0{suffix}\n")).collect()


def test_failure_names_file_and_row(spark, text_file):
    with pytest.raises(Exception, match="(?s)B;x.*measurements.txt"):
        scan_lines(spark, text_file("A;1.0\nB;x\n")).collect()


@pytest.mark.parametrize("scan", SCANS)
def test_strict_without_ansi(spark, text_file, scan):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            scan(spark, text_file("A;1.0\nB;x\n")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_lenient_lines_keep_every_row(spark, text_file):
    df = scan_lines(spark, text_file("A;1.0\nB;x\nC\nD;1;2\n"), strict=False)
    assert sorted(map(tuple, df.collect())) == [("A", 1.0), ("B", None), ("C", None), ("D", None)]


def test_rejected_lines(spark, text_file):
    lines = spark.read.text(text_file("A;1.0\nB;x\n\nC\nD;1;2\nE;\nF;NaN\nG;2f\n"))
    found = {row.line: row.reason for row in rejected_lines(lines).collect()}
    assert found == {
        "B;x": "not a finite number",
        "C": "no delimiter",
        "D;1;2": "extra field",
        "E;": "no value",
        "F;NaN": "not a finite number",
        "G;2f": "not a finite number",
    }


def test_rejected_lines_are_those_a_strict_scan_fails_on(spark, text_file):
    for case, content in BAD.items():
        assert rejected_lines(spark.read.text(text_file(content))).count() == 1, case
    for case, (content, _) in GOOD.items():
        assert rejected_lines(spark.read.text(text_file(content))).count() == 0, case


def test_other_separators(spark, text_file):
    path = text_file("A\t1.0\nB;b\t2.0\n")
    for scan in SCANS:
        assert sorted(map(tuple, scan(spark, path, sep="\t").collect())) == [("A", 1.0), ("B;b", 2.0)]
    path = text_file("A§1.0\n")
    assert scan_lines(spark, path, sep="§").first() == ("A", 1.0)


def test_more_columns(spark, text_file):
    path = text_file("A;3;1.5\n")
    df = scan_delimited(spark, path, ["name", "n", "x"], {2: "INT", "x": "DECIMAL(3,1)"})
    assert df.dtypes == [("name", "string"), ("n", "int"), ("x", "decimal(3,1)")]
    assert str(df.first().x) == "1.5"
    for bad in ("A;;1.5\n", "A;3;\n", "A;3\n", "A;3;1.5;9\n", "A;q;1.5\n"):
        with pytest.raises(Exception):
            scan_delimited(spark, text_file(bad), ["name", "n", "x"], {2: "INT", "x": "DECIMAL(3,1)"}).count()


def test_schema_forms_agree(spark):
    wanted = build_schema(types={"temp": "DOUBLE"})
    assert build_schema(types={2: "DOUBLE"}) == wanted
    assert build_schema(types=["STRING", "DOUBLE"]) == wanted
    assert [f.dataType.simpleString() for f in build_schema()] == ["string", "string"]


@pytest.mark.parametrize("types", [{"other": "INT"}, {0: "INT"}, {3: "INT"}, ["STRING"]])
def test_schema_rejects_unknown_columns(spark, types):
    with pytest.raises(ValueError):
        build_schema(types=types)


def test_preview(spark, text_file):
    df = scan_lines(spark, text_file("B;2.0\nA;1.0\nC;3.0\n"))
    assert [r.station for r in preview(df, 2, "station").collect()] == ["A", "B"]
    assert preview(df, 2).count() == 2
    assert preview(df, 9).count() == 3


@pytest.mark.parametrize("ending", ["\n", ""])
def test_chunk_hint_changes_no_result(spark, text_file, ending):
    content = "\n".join(f"S{i % 7};{(i * 37 % 1999 - 999) / 10}" for i in range(5000)) + ending
    path = text_file(content)
    wanted = station_summary(scan_lines(spark, path)).collect()
    assert input_bytes(spark, path) == len(content.encode())
    splits = {}
    for num_chunks in (1, 2, 24):
        rows = scan_chunks(spark, path, num_chunks)
        splits[num_chunks] = rows.select("chunk").distinct().count()
        assert rows.count() == 5000
        assert merge_state(partial_state(rows)).orderBy("station").collect() == wanted
    assert splits[1] == 1
    assert splits[2] in (2, 3)
    assert splits[24] in (24, 25)


def test_chunk_hint_leaves_the_session_alone(spark, text_file):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    scan_chunks(spark, text_file("A;1.0\n"), 3).collect()
    assert spark.conf.get(name) == before
    with pytest.raises(ValueError):
        scan_chunks(spark, text_file("A;1.0\n"), 0)


@pytest.mark.parametrize("setting, size", [("134217728", 1 << 27), ("128MB", 1 << 27), ("64k", 1 << 16), ("7b", 7)])
def test_chunks_are_no_larger_than_the_session_allows(spark, text_file, setting, size):
    name = "spark.sql.files.maxPartitionBytes"
    path = text_file("A;1.0\n" * 50)
    spark.conf.set(name, setting)
    try:
        session = session_for_chunks(spark, path, 1)
    finally:
        spark.conf.unset(name)
    assert session.conf.get(name) == setting
    assert session.read.text(path).rdd.getNumPartitions() == -(-300 // min(300, size))


def test_small_files_share_splits(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i}.txt").write_text("A;1.0\n" * 100)
    rows = scan_chunks(spark, str(tmp_path), 4)
    assert rows.rdd.getNumPartitions() in (4, 5)
    assert rows.select("chunk").distinct().count() == 60
    assert rows.count() == 6000


def test_the_size_takes_no_job(spark, text_file):
    path = text_file("A;1.0\n" * 50)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size", "size")
    try:
        assert input_bytes(spark, path) == 300
        session_for_chunks(spark, path, 3)
        assert list(tracker.getJobIdsForGroup("size")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_written_lines_read_back(spark, measurements, tmp_path):
    rows = [(0, "Zürich", -0.1), (0, "A", 99.9), (1, "big", 12345678.9), (1, "A", 0.0)]
    df = measurements(rows)
    path = str(tmp_path / "out")
    write_lines(df, path, scale=1)
    wanted = sorted((s, t) for _, s, t in rows)
    for scan in SCANS:
        assert sorted(map(tuple, scan(spark, path).collect())) == wanted


names = st.text(st.characters(exclude_characters=";\n\r", exclude_categories=["Cs"]), max_size=12)
tenths = st.integers(-999, 999).map(lambda n: n / 10)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(names, tenths), min_size=1, max_size=20))
def test_any_name_comes_through(spark, rows):
    df = spark.createDataFrame([(f"{name};{temp}",) for name, temp in rows], "value STRING")
    assert sorted(map(tuple, parse_lines(df).collect())) == sorted(rows)
    assert rejected_lines(df).count() == 0


def test_parse_lines_keeps_other_columns(spark):
    df = spark.createDataFrame([(7, "A;1.5")], "id INT, value STRING")
    assert parse_lines(df).first() == (7, "A", 1.5)


@pytest.mark.parametrize("row", [(0, None, 1.0), (0, "A", None), (0, "A", 1.25), (0, "A;B", 1.0), (0, "A\nB", 1.0), (0, "A", float("nan")), (0, "A", float("inf"))])
def test_lines_that_would_not_come_back_are_not_written(measurements, tmp_path, row):
    with pytest.raises(Exception, match="cannot be written|does not fit"):
        write_lines(measurements([(0, "B", 2.0), row]), str(tmp_path / "out"), scale=1)


BAD_NUMBERS = ["1.0d", "1.0d ", "1.0f", "0x1p3", "x", "", "NaN", "Infinity", "-inf"]
FILTERS = ["temp > 5", "temp < 5", "station = 'A'", "true"]


@pytest.mark.parametrize("number", BAD_NUMBERS)
@pytest.mark.parametrize("scan", [scan_lines, scan_delimited, scan_late_cast])
def test_no_filter_hides_a_bad_number(spark, text_file, scan, number):
    path = text_file(f"A;1.0\nB;{number}\nC;9.0\n")
    for condition in FILTERS:
        with pytest.raises(Exception, match="bad row|not finite|MALFORMED|FAILED_READ"):
            scan(spark, path).filter(condition).collect()
    with pytest.raises(Exception, match="bad row|not finite|MALFORMED|FAILED_READ"):
        scan(spark, path).count()


@pytest.mark.parametrize("line", ["B", "B;2.0;3"])
@pytest.mark.parametrize("scan", [scan_lines, scan_delimited, scan_late_cast])
def test_no_filter_hides_a_bad_row(spark, text_file, scan, line):
    path = text_file(f"A;1.0\n{line}\nC;9.0\n")
    for condition in FILTERS:
        with pytest.raises(Exception, match="bad row|MALFORMED|FAILED_READ"):
            scan(spark, path).filter(condition).select("station").collect()


def test_no_filter_hides_a_bad_third_column(spark, text_file):
    path = text_file("A;1.0;3\nB;2.0;x\n")
    df = scan_delimited(spark, path, ("station", "temp", "n"), {"temp": "DOUBLE", "n": "INT"})
    assert df.schema.simpleString() == "struct<station:string,temp:double,n:int>"
    for condition in ("n = 3", "temp > 5", "station = 'A'", "n IS NULL"):
        with pytest.raises(Exception, match="bad row"):
            df.filter(condition).select("station").collect()
    with pytest.raises(Exception, match="bad row"):
        df.count()


@pytest.mark.parametrize("scan", [scan_lines, scan_delimited, scan_late_cast])
def test_blank_lines_are_skipped_alike(spark, text_file, scan):
    path = text_file("A;1.0\n\n   \n\t\nB; 2.0 \n")
    assert sorted(map(tuple, scan(spark, path).collect())) == [("A", 1.0), ("B", 2.0)]
