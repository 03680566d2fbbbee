"""The summary as text and as maps.

These take unrounded statistics: the text keeps the sign of a mean that rounds
to zero, which the rounded number no longer has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import format_rounded, whole_part
from ..schema import STATION
from .numbering import number_rows
from .summary import RESULT, rounded

LINES_PER_PART = 100_000
ENTRIES_PER_MAP = 10_000


def _named(stats: DataFrame) -> DataFrame:
    """``stats``, failing on a row without a station: neither text nor a map can hold it."""
    missing = F.raise_error(F.lit("a station without a name cannot be reported"))
    return stats.withColumn(STATION, F.coalesce(F.col(STATION), missing.cast("string")))


def report_lines(
    stats: DataFrame, digits: int = 1, columns: Sequence[str] = RESULT
) -> DataFrame:
    """``station, line``, a line being ``Oslo=-3.1/4.2/21.0``.

    ``columns`` are rounded; the others are printed as they are. A missing number is ``null``.
    """
    texts = [format_rounded(F.col(c), digits) if c in columns else F.col(c).cast("string") for c in RESULT]
    numbers = F.concat_ws("/", *[F.coalesce(F.when(F.col(c).isNotNull(), t), F.lit("null")) for c, t in zip(RESULT, texts, strict=True)])
    return _named(stats).select(STATION, F.concat(F.col(STATION), F.lit("="), numbers).alias("line"))


def write_report_lines(
    stats: DataFrame, path: str, digits: int = 1, columns: Sequence[str] = RESULT
) -> None:
    """One line per station, in order through the files of ``path``."""
    report_lines(stats, digits, columns).orderBy(STATION).select("line").write.text(path)


def report_string(
    stats: DataFrame,
    digits: int = 1,
    trailing_sep: bool = False,
    lines_per_part: int = LINES_PER_PART,
    columns: Sequence[str] = RESULT,
) -> DataFrame:
    """The report ``{A=…, B=…}`` sorted by station, as ``part, report``.

    One row holds the whole report for up to ``lines_per_part`` stations. More
    stations give more rows; in order of ``part`` they add up to the same text.
    """
    lines, total = number_rows(report_lines(stats, digits, columns), STATION)
    if total == 0:
        return stats.sparkSession.range(1).select(
            F.lit(0).cast("bigint").alias("part"), F.lit("{}").alias("report")
        )
    last = (total - 1) // lines_per_part
    part = whole_part(F.col("row_no"), lines_per_part)
    in_order = F.array_sort(F.collect_list(F.struct("row_no", "line")))
    text = F.array_join(F.transform(in_order, lambda entry: entry["line"]), ", ")
    opening = F.when(F.col("part") == 0, "{").otherwise("")
    closing = F.when(F.col("part") < last, ", ").otherwise(", }" if trailing_sep else "}")
    return (
        lines.groupBy(part.alias("part"))
        .agg(text.alias("report"))
        .select("part", F.concat(opening, "report", closing).alias("report"))
        .orderBy("part")
    )


def summary_map(
    stats: DataFrame, digits: int | None = 1, entries_per_map: int = ENTRIES_PER_MAP
) -> DataFrame:
    """``part, summary``: maps from station to ``[min, mean, max]``.

    The maps hold consecutive stations, ``entries_per_map`` each, so a station is
    looked up in all of them; one has it. A row without a station fails.
    """
    entries = _named(stats) if digits is None else rounded(_named(stats), digits)
    numbered, _ = number_rows(entries.select(STATION, F.array(*RESULT).alias("numbers")), STATION)
    part = whole_part(F.col("row_no"), entries_per_map)
    pairs = F.collect_list(F.struct(STATION, "numbers"))
    return numbered.groupBy(part.alias("part")).agg(F.map_from_entries(pairs).alias("summary"))


def map_rows(maps: DataFrame) -> DataFrame:
    """The flat table back from the maps, by looking up each of their keys."""
    found = maps.select("summary", F.explode(F.map_keys("summary")).alias(STATION)).select(
        STATION, F.element_at("summary", F.col(STATION)).alias("numbers")
    )
    return found.select(STATION, *[F.col("numbers")[i].alias(c) for i, c in enumerate(RESULT)])
