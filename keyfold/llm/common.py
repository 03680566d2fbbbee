"""What several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# A table that is broadcast is measured first and holds no more than this.
BROADCAST_BYTES = 32 << 20

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, where ``value`` is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def join_measured(df: DataFrame, small: DataFrame, on, how: str = "inner", row_bytes: int = 256) -> DataFrame:
    """Join a stored table. It is broadcast only if its row count keeps it within bounds.

    Beyond that it is a shuffle join, whose hot keys adaptive execution splits.
    """
    if small.count() * row_bytes <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return df.join(small, on, how)
