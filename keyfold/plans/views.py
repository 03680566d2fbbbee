"""The given tables seen as measurements: ``station, temp, chunk``.

All numbers in them have two decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATION, TEMP
from ..sources.delimited import write_chunk_files, write_lines
from ..storage import new_path

SCALE = 2
CHUNKS = 24
CUSTOMER_CHUNKS = 8
# Rows per chunk where a chunk's values are held in one list.
LIST_ROWS = 4096


# The columns in use. Stating them saves the job that reads them from a footer.
COLUMNS = {
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING",
    "lineitem": "l_partkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE",
    "documents": "doc_id BIGINT, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(df: DataFrame, station: Column, temp: str, chunk: Column, *more: str) -> DataFrame:
    return df.select(
        *more, station.alias(STATION), F.col(temp).alias(TEMP), chunk.cast("bigint").alias("chunk")
    )


def by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few stations, all of them hot."""
    chunk = F.pmod("event_id", F.lit(CHUNKS))
    return _view(table(spark, sf_dir, "events"), F.col("event_type"), "value", chunk, "event_id")


def by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = F.pmod("event_id", F.lit(CHUNKS))
    user = F.col("user_id").cast("string")
    return _view(table(spark, sf_dir, "events"), user, "value", chunk, "event_id", "event_type")


def by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Has negative values."""
    chunk = F.pmod("c_custkey", F.lit(CUSTOMER_CHUNKS))
    return _view(table(spark, sf_dir, "customer"), F.col("c_mktsegment"), "c_acctbal", chunk)


def by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many stations."""
    part = F.col("l_partkey").cast("string")
    return _view(table(spark, sf_dir, "lineitem"), part, "l_extendedprice", F.col("l_linenumber"))


def as_text(df: DataFrame, rows_per_file: int = 0) -> str:
    """Write the measurements as ``station;temp`` text and return where."""
    path = new_path(df.sparkSession, "text")
    write_lines(df, path, SCALE, rows_per_file=rows_per_file)
    return path


def as_chunk_files(df: DataFrame) -> str:
    """Write the measurements as text, one file for each chunk, and return where."""
    path = new_path(df.sparkSession, "chunks")
    write_chunk_files(df, path, SCALE)
    return path


def by_whole_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the whole part of their value: 0 to 490."""
    whole = F.floor("value").cast("string")
    return _view(table(spark, sf_dir, "events"), whole, "value", F.lit(0), "event_id")


def by_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by tens of their balance: -100 to 999."""
    tens = F.floor(F.col("c_acctbal") / 10).cast("string")
    return _view(table(spark, sf_dir, "customer"), tens, "c_acctbal", F.lit(0))
