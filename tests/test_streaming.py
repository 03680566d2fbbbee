"""The streamed summary equals the batch one, in one run or several."""

import os
import random

import pytest

from keyfold import incremental_stats, latest_stats, run_available, scan_lines, station_stats


def write_file(folder, name, seed, stations):
    pick = random.Random(seed)
    rows = [f"S{pick.randrange(stations)};{pick.randrange(-999, 1000) / 10}" for _ in range(200)]
    (folder / name).write_text("\n".join(rows) + "\n")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_files_that_arrive_later_are_folded_in(spark, tmp_path, mode):
    incoming, table, checkpoint = (tmp_path / n for n in ("in", "out", "checkpoint"))
    incoming.mkdir()

    def run():
        stats = incremental_stats(spark, str(incoming), max_files=1)
        run_available(stats, str(table), str(checkpoint), mode)
        found = rows_of(latest_stats(spark, str(table)))
        assert found == rows_of(station_stats(scan_lines(spark, str(incoming))))

    write_file(incoming, "a.txt", 1, 10)
    write_file(incoming, "b.txt", 2, 10)
    run()
    assert len(list(table.glob("batch=*"))) == 2
    # Fewer stations: the others must keep what they had.
    write_file(incoming, "c.txt", 3, 3)
    run()
    assert len(list(table.glob("batch=*"))) == 3


def test_update_mode_writes_only_what_changed(spark, tmp_path):
    incoming, table, checkpoint = (tmp_path / n for n in ("in", "out", "checkpoint"))
    incoming.mkdir()
    (incoming / "a.txt").write_text("A;1.0\nB;2.0\n")
    stats = incremental_stats(spark, str(incoming))
    run_available(stats, str(table), str(checkpoint))
    (incoming / "b.txt").write_text("B;4.0\n")
    run_available(incremental_stats(spark, str(incoming)), str(table), str(checkpoint))
    second = spark.read.parquet(str(table / "batch=1"))
    assert rows_of(second) == [("B", 2.0, 3.0, 4.0)]
    assert rows_of(latest_stats(spark, str(table))) == [("A", 1.0, 1.0, 1.0), ("B", 2.0, 3.0, 4.0)]


def test_a_bad_row_stops_the_stream(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.txt").write_text("A;1.0\nB;x\n")
    stats = incremental_stats(spark, str(incoming))
    with pytest.raises(Exception, match="bad row"):
        run_available(stats, str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_state_is_in_rocksdb_and_outlives_a_stop(spark, tmp_path):
    """Stopped half way, the stream goes on from its checkpoint and gives what a batch gives."""
    incoming, table, checkpoint = (tmp_path / n for n in ("in", "out", "checkpoint"))
    incoming.mkdir()
    for i in range(6):
        write_file(incoming, f"f{i}.txt", i, 50)
    # A file that fails in the middle stops the run after some batches.
    good = (incoming / "f3.txt").read_text()
    (incoming / "f3.txt").write_text("broken\n")
    # Files are taken in the order of their age.
    ages = lambda: [os.utime(incoming / f"f{i}.txt", (10**9 + i, 10**9 + i)) for i in range(6)]
    ages()
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(Exception, match="bad row"):
            run_available(incremental_stats(spark, str(incoming), max_files=1), str(table), str(checkpoint))
        done = len(list(table.glob("batch=*/_SUCCESS")))
        assert done == 3
        (incoming / "f3.txt").write_text(good)
        ages()
        progress = run_available(incremental_stats(spark, str(incoming), max_files=1), str(table), str(checkpoint))
        assert "HDFS" in spark.conf.get(provider)
    finally:
        spark.conf.set(provider, before)
    assert sum(p["numInputRows"] for p in progress) == 600
    state = progress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] == 50
    assert any(name.startswith("rocksdb") for name in state["customMetrics"])
    assert list(checkpoint.glob("state/0/*/*.changelog"))
    assert rows_of(latest_stats(spark, str(table))) == rows_of(station_stats(scan_lines(spark, str(incoming))))
