"""A strict scan that keeps the good rows and sets the bad ones aside, in one pass."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import SEP, after_sep, before_sep, finite_number, is_blank
from ..schema import STATION, TEMP
from .delimited import reject_reason


class Divided(NamedTuple):
    """``good`` has ``station, temp``, ``rejected`` has ``line, reason``; ``counts`` is by kind of line."""

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def divide_lines(lines: DataFrame, into: str, sep: str = SEP) -> Divided:
    """Write the rows of a text column ``value`` to ``into``: what a strict scan takes, and what it fails on.

    The input is read once. ``counts`` has the lines that are good, rejected and
    blank, as the writing tasks saw them; together they are all lines. A second run
    with the same folder replaces the first.
    """
    spark, line = lines.sparkSession, F.col("value")
    blank = is_blank(line, sep)
    marked = lines.select(line, F.when(~blank, reject_reason(line, sep)).alias("reason"), blank.alias("blank"))
    kinds = {"good": ~F.col("blank") & F.col("reason").isNull(), "rejected": F.col("reason").isNotNull(), "blank": F.col("blank")}
    seen = Observation()
    observed = marked.observe(seen, *[F.count_if(kind).alias(name) for name, kind in kinds.items()])
    good = F.col("reason").isNull()
    rows = observed.filter("NOT blank").select(
        F.when(good, before_sep(line, sep)).alias(STATION),
        F.when(good, finite_number(after_sep(line, sep))).alias(TEMP),
        F.when(~good, line).alias("line"),
        "reason",
        F.when(good, "good").otherwise("rejected").alias("kind"),
    )
    rows.write.mode("overwrite").partitionBy("kind").parquet(into)
    schema = f"{STATION} STRING, {TEMP} DOUBLE, line STRING, reason STRING, kind STRING"
    written = spark.read.schema(schema).parquet(into)
    return Divided(
        written.filter("kind = 'good'").select(STATION, TEMP),
        written.filter("kind = 'rejected'").select("line", "reason"),
        {name: int(n) for name, n in seen.get.items()},
    )
