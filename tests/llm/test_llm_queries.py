"""The queries that SQL can express, against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from keyfold.llm.oracle import ORACLE
from keyfold.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows_of(df_or_cursor, columns):
    return sorted((tuple(r[i] for i in columns) for r in df_or_cursor), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = con.execute(ORACLE[name])
    names = [c[0] for c in wanted.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    found = rows_of(df.collect(), [df.columns.index(c) for c in sorted(names)])
    assert found == rows_of(wanted.fetchall(), [names.index(c) for c in sorted(names)])


def test_all_are_registered():
    registered = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert set(ORACLE) <= set(entry_points.oracle_sql())
