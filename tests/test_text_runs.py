"""Chunks that stay the same, reading the head only, and strict scans that keep the good rows."""

import os

import pytest
from pyspark.sql import functions as F

from keyfold.plans.from_text import chunk_mean_report
from keyfold.sources import delimited, divided, head

from plan_metrics import bytes_read, metric, named


@pytest.fixture
def folder(tmp_path):
    """One file a chunk: A has its rows in both, unevenly."""
    path = tmp_path / "chunks"
    path.mkdir()
    (path / "a.txt").write_text("A;10.0\nA;20.0\nA;30.0\nB;1.0\n")
    (path / "b.txt").write_text("A;0.0\n\nC;5.0\n")
    return str(path)


SETTINGS = [("4m", "1"), ("128m", "200"), ("64", "1"), ("1k", "7")]


@pytest.mark.parametrize("size, partitions", SETTINGS)
def test_mean_of_file_means_is_the_same_at_any_setting(spark, folder, size, partitions):
    """Small splits cut the files in many; a chunk stays a file."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", size)
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    report = chunk_mean_report(session, folder).first().report
    assert report == "{A=0.0/10.0/30.0, B=1.0/1.0/1.0, C=5.0/5.0/5.0}"


def test_chunks_name_file_and_place(spark, tmp_path):
    path = tmp_path / "large.txt"
    path.write_text("".join(f"s{i % 7};{i % 100}.5\n" for i in range(60_000)))
    chunks = delimited.scan_chunks(spark, str(path), 5)
    found = sorted(map(tuple, chunks.groupBy("chunk.file", "chunk.start").count().collect()))
    assert len(found) >= 5 and sum(n for _, _, n in found) == 60_000
    assert {os.path.basename(f) for f, _, _ in found} == {"large.txt"}
    assert found[0][1] == 0 and len({start for _, start, _ in found}) == len(found)
    # The same places however many tasks read them, and read again.
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "3")
    again = delimited.scan_chunks(session, str(path), 5).groupBy("chunk.file", "chunk.start").count()
    assert sorted(map(tuple, again.collect())) == found


def test_small_files_packed_together_stay_apart(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i:02}.txt").write_text(f"A;{i}.0\n")
    chunks = delimited.scan_chunks(spark, str(tmp_path), 2)
    assert chunks.rdd.getNumPartitions() < 40
    assert chunks.select("chunk").distinct().count() == 40


@pytest.fixture(scope="module")
def large_folder(spark, tmp_path_factory):
    """Files of some megabytes, their order that of their rows."""
    path = str(tmp_path_factory.mktemp("head") / "text")
    line = F.concat(F.lit("station "), F.col("id").cast("string"), F.lit(";1.5"))
    spark.range(0, 2_000_000, numPartitions=4).select(line.alias("value")).write.text(path)
    return path


def test_head_reads_the_beginning_of_one_file(spark, large_folder):
    lines = head.head_lines(spark, large_folder, 5)
    (scan,) = named(lines, "Scan text")
    assert metric(scan, "numFiles") == 1
    read, rows = bytes_read(spark, lambda: head.preview_head(spark, large_folder, 5).collect())
    assert [r.station for r in rows] == [f"station {i}" for i in range(5)]
    assert read < 500_000 < os.path.getsize(next(e.path for e in os.scandir(large_folder) if e.name.endswith(".txt"))) / 8


def test_head_goes_on_to_the_next_files(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i:02}.txt").write_text("\n \n" if i % 3 else f"s{i};{i}.0\n\n")
    (tmp_path / "f00.txt").write_text("")
    found = [r.station for r in head.preview_head(spark, str(tmp_path), 12).collect()]
    assert found == [f"s{i}" for i in range(3, 39, 3)]
    assert head.preview_head(spark, str(tmp_path), 100).count() == 13
    assert head.preview_head(spark, str(tmp_path), 0).collect() == []


def test_a_bad_row_matters_within_the_head_only(spark, text_file):
    path = text_file("A;1.0\nB;2.0\nC;x\n")
    assert head.preview_head(spark, path, 2).count() == 2
    with pytest.raises(Exception, match="bad row"):
        head.preview_head(spark, path, 3).collect()
    assert [r.temp for r in head.preview_head(spark, path, 3, strict=False).collect()] == [1.0, 2.0, None]


MIXED = "A;1.0\n\nB;x\nC\n  \nD;1;2\nE;\n\"F\";2.5\nG;1e400\nA;1.0\n;7.0\nH;1.0d\n"


def test_good_rows_and_rejects_of_one_pass(spark, text_file, tmp_path):
    lines = spark.read.text(text_file(MIXED))
    got = divided.divide_lines(lines, str(tmp_path / "out"))
    assert sorted(map(tuple, got.good.collect())) == [("", 7.0), ('"F"', 2.5), ("A", 1.0), ("A", 1.0)]
    assert sorted(map(tuple, got.rejected.collect())) == sorted(map(tuple, delimited.rejected_lines(lines).collect()))
    assert got.counts == {"good": 4, "rejected": 6, "blank": 2}
    assert sum(got.counts.values()) == lines.count()


def test_rejects_read_the_input_once(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text("".join(f"s{i % 7};{i % 100}.5\n" if i % 10 else "bad\n" for i in range(300_000)))
    size = path.stat().st_size
    read, got = bytes_read(spark, lambda: divided.divide_lines(spark.read.text(str(path)), str(tmp_path / "out")))
    # Splits read on to the end of their last line.
    assert size <= read < 1.3 * size
    assert got.counts == {"good": 270_000, "rejected": 30_000, "blank": 0}
    assert (got.good.count(), got.rejected.count()) == (270_000, 30_000)


def test_second_run_replaces_and_empty_input(spark, text_file, tmp_path):
    out = str(tmp_path / "out")
    divided.divide_lines(spark.read.text(text_file(MIXED)), out)
    got = divided.divide_lines(spark.read.text(text_file("A;1.0\n", "other.txt")), out)
    assert (got.good.count(), got.rejected.count()) == (1, 0)
    none = divided.divide_lines(spark.read.text(text_file("", "none.txt")), out)
    assert (none.good.count(), none.counts) == (0, {"good": 0, "rejected": 0, "blank": 0})
