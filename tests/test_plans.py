"""What the plans look like: columns read, filters pushed down, work before the shuffle."""

import pathlib
import re
import subprocess
import sys

import pytest

from keyfold import scan_lines, station_stats, station_summary
from keyfold.plans import views
from keyfold.plans.queries import QUERIES
from keyfold.storage import shared_folder


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["station_summary", "station_summary_wide", "merge_state", "mean_of_means"])
def test_rows_are_folded_before_the_first_shuffle(spark, sf_dir, name):
    tree = tree_of(QUERIES[name](spark, sf_dir))
    after_last_exchange = tree.rsplit("Exchange", 1)[1]
    assert "HashAggregate" in after_last_exchange
    assert "ObjectHashAggregate" not in tree and "SortAggregate" not in tree


def test_only_two_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["station_summary_wide"](spark, sf_dir))
    assert "struct<l_partkey:bigint,l_extendedprice:double>" in plan


def test_one_shuffle_before_the_sort(spark, sf_dir):
    tree = tree_of(station_stats(views.by_part(spark, sf_dir), views.SCALE))
    assert tree.count("Exchange") == 1
    tree = tree_of(station_summary(views.by_part(spark, sf_dir), views.SCALE))
    assert len(re.findall("Exchange hashpartitioning", tree)) == 1
    assert len(re.findall("Exchange rangepartitioning", tree)) == 1


def test_key_filter_reaches_the_scan(spark, sf_dir):
    assert "EqualTo(event_type,click)" in plan_of(QUERIES["filter_station"](spark, sf_dir))


def test_small_key_join_shuffles_nothing(spark, sf_dir):
    assert "Exchange hashpartitioning" not in tree_of(QUERIES["station_semi"](spark, sf_dir))


def test_no_python_but_in_apply(spark, sf_dir):
    for name in ("station_summary", "partial_state", "list_summary", "fn_round", "scan_lines"):
        tree = tree_of(QUERIES[name](spark, sf_dir))
        assert "Python" not in tree and "Pandas" not in tree, name
    assert "InPandas" in tree_of(QUERIES["apply_per_batch"](spark, sf_dir))


def test_a_line_is_parsed_once(spark, text_file):
    tree = tree_of(station_stats(scan_lines(spark, text_file("A;1.0\n"))))
    assert tree.count("try_cast") == 1


def test_no_query_joins_every_row_with_every_row(spark, sf_dir):
    for name, query in QUERIES.items():
        if name.startswith("stream"):
            continue
        tree = tree_of(query(spark, sf_dir))
        assert "CartesianProduct" not in tree and "NestedLoop" not in tree, name


NAMED_FOLDER = """
import sys
from pyspark.sql import SparkSession
from keyfold.storage import shared_folder, store

spark = (
    SparkSession.builder.master("local[1]")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[1])
    .getOrCreate()
)
assert shared_folder(spark) == sys.argv[1], shared_folder(spark)
assert store(spark.range(3), "three").count() == 3
"""


def test_stored_tables_go_to_the_named_folder(tmp_path):
    # The setting is fixed when a session starts, hence a session of its own.
    root = pathlib.Path(__file__).resolve().parents[1]
    subprocess.run(
        [sys.executable, "-c", NAMED_FOLDER, str(tmp_path)], cwd=root, check=True, timeout=120
    )
    assert list(tmp_path.glob("keyfold-three-*"))


class _Cluster:
    """A session of a cluster that names no folder."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "spark://somewhere"
        getConf = staticmethod(dict)
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Cluster)
