"""The first rows of text files, reading their beginning only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SEP, is_blank
from .delimited import like_session, parse_lines

# Files looked up at once.
_FILES = 16
_WHOLE_FILE = str((1 << 63) - 1)


def files_in_order(spark: SparkSession, path: str | Sequence[str]) -> Iterator[str]:
    """Files with content by the order of their paths, a few at a time. None of them is opened."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    last = ""
    while True:
        rows = listed.filter(F.col("path") > F.lit(last)).orderBy("path").limit(_FILES).collect()
        yield from (r["path"] for r in rows)
        if len(rows) < _FILES:
            return
        last = rows[-1]["path"]


def head_lines(spark: SparkSession, path: str | Sequence[str], n: int, sep: str = SEP) -> DataFrame:
    """``value``: the first ``n`` lines that are not blank, files taken by the order of their paths.

    A file is one split whatever its size, and its task stops after ``n`` lines, so
    only the beginning is read. Further files are opened only if those before them
    have fewer lines.
    """
    session = like_session(spark)
    session.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    parts, left = [], n
    for file in files_in_order(spark, path) if n > 0 else ():
        lines = session.read.text(file)
        part = lines.filter(~is_blank(F.col("value"), sep)).limit(left)
        found = part.count()
        if found:
            parts.append(part)
            left -= found
        if not left:
            break
    return reduce(DataFrame.unionAll, parts) if parts else session.createDataFrame([], "value STRING")


def preview_head(spark: SparkSession, path: str | Sequence[str], n: int, sep: str = SEP, strict: bool = True) -> DataFrame:
    """``station, temp`` of the first ``n`` lines. Strict, a bad row among them fails the job."""
    return parse_lines(head_lines(spark, path, n, sep), sep, strict)
