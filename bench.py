"""Times every query and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores. Each query
runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Queries
that write text or tables on the way include that.

Throughput is taken on text of ``BENCH_TEXT_ROWS`` rows (10 million unless given,
0 for none) that is generated first: 9,000 stations even, and again with a third
of the rows in one station.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from keyfold.operators.summary import station_summary
from keyfold.plans import views
from keyfold.plans.queries import QUERIES
from keyfold.session import local_session
from keyfold.sources.delimited import scan_lines
from keyfold.storage import new_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
TEXT_ROWS = int(os.environ.get("BENCH_TEXT_ROWS", "10000000"))
STATIONS = 9000
BASELINE_PER_THREAD = 10**9 / 60.4 / 24


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def generated_text(spark, rows: int, hot: bool) -> str:
    """``station;temp`` text with one decimal, -99.9 to 99.9."""
    path = new_path(spark, "bench")
    number = F.pmod(F.xxhash64("id"), F.lit(STATIONS))
    station = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit(0)).otherwise(number)
    temp = ((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1999)) - 999) / 10).cast("decimal(4,1)")
    line = F.concat(F.lit("Station "), station.cast("string"), F.lit(";"), temp.cast("string"))
    spark.range(rows).select(line.alias("value")).write.text(path)
    return path


def main():
    spark = local_session(CPUS, "16g", "keyfold-bench")
    # The headline: text that is already there, summarised per station.
    lines = views.by_part(spark, SF_DIR)
    text, rows = views.as_text(lines), lines.count()
    seconds = {
        "text_to_summary": median_seconds(
            lambda: consume(station_summary(scan_lines(spark, text), views.SCALE))
        )
    }
    for name, query in QUERIES.items():
        seconds[name] = median_seconds(lambda: consume(query(spark, SF_DIR)))
    throughput = {}
    for name, hot in (("even", False), ("hot_station", True)) if TEXT_ROWS else ():
        path = generated_text(spark, TEXT_ROWS, hot)
        took = median_seconds(lambda: consume(station_summary(scan_lines(spark, path))))  # noqa: B023
        throughput[name] = {
            "rows": TEXT_ROWS,
            "sec": round(took, 3),
            "rows_per_sec": round(TEXT_ROWS / took),
            "rows_per_sec_per_core": round(TEXT_ROWS / took / CPUS),
            "per_core_over_baseline_thread": round(TEXT_ROWS / took / CPUS / BASELINE_PER_THREAD, 2),
        }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in seconds.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cores": CPUS,
                "text_rows": rows,
                "text_rows_per_sec": round(rows / seconds["text_to_summary"]),
                "throughput": throughput,
            }
        )
    )


if __name__ == "__main__":
    main()
