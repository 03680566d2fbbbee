"""Every registered query against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from keyfold.plans.oracle import ORACLE
from keyfold.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = []
    for row in rows:
        for value in row:
            assert not (isinstance(value, float) and value == 0 and math.copysign(1, value) < 0)
        lines.append(tuple((str(type(row[i]).__name__), row[i]) for i in order))
    return sorted(lines, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = con.execute(ORACLE[name])
    columns = [c[0] for c in wanted.description]
    wanted = wanted.fetchall()
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    found = [tuple(row) for row in df.collect()]
    assert wanted
    assert canonical(found, df.columns) == canonical(wanted, columns)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["station", "t_min", "t_mean", "t_max"]
    assert df.count() == 5
