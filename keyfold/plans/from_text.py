"""From a text file to the printed form, both ways of merging chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.partial import chunk_summary, mean_of_means
from ..operators.report import report_string
from ..operators.summary import RESULT, station_stats
from ..sources.delimited import scan_chunks, scan_lines


def station_report(
    spark: SparkSession,
    path: str,
    scale: int | None = 1,
    trailing_sep: bool = False,
    columns: Sequence[str] = RESULT,
) -> DataFrame:
    """The report with true means. ``columns`` are rounded, the others printed as they are."""
    stats = station_stats(scan_lines(spark, path), scale)
    return report_string(stats, trailing_sep=trailing_sep, columns=columns)


def chunk_mean_report(
    spark: SparkSession,
    path: str,
    num_chunks: int | None = None,
    scale: int | None = 1,
    trailing_sep: bool = False,
    columns: Sequence[str] = RESULT,
) -> DataFrame:
    """The report with the mean of the means of the chunks of the input.

    Chunks are the files, or, with ``num_chunks``, parts of them, as ``scan_chunks``
    says. The mean depends on where they are cut. ``columns`` are rounded, the
    others printed as they are.
    """
    chunks = chunk_summary(scan_chunks(spark, path, num_chunks), scale)
    means = mean_of_means(chunks, digits=None, exact=scale is not None)
    return report_string(means, trailing_sep=trailing_sep, columns=columns)
