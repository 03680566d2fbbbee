"""Per-chunk states and summaries, and the ways to merge them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, exact_sum, one_zero
from ..schema import STATION, TEMP
from .summary import rounded

CHUNK = "chunk"


def partial_state(df: DataFrame, scale: int | None = 1, chunk: str = CHUNK) -> DataFrame:
    """``chunk, station, t_min, t_sum, t_max, n``; ``t_sum`` is exact."""
    temp = one_zero(F.col(TEMP))
    return df.groupBy(chunk, STATION).agg(
        F.min(temp).alias("t_min"),
        exact_sum(temp, scale).alias("t_sum"),
        F.max(temp).alias("t_max"),
        F.count(temp).alias("n"),
    )


def merge_state(states: DataFrame, digits: int | None = 1) -> DataFrame:
    """Least minimum, total sum over total count, greatest maximum."""
    merged = states.groupBy(STATION).agg(
        F.min("t_min").alias("t_min"),
        (F.sum("t_sum").cast("double") / F.sum("n")).alias("t_mean"),
        F.max("t_max").alias("t_max"),
    )
    return merged if digits is None else rounded(merged, digits)


def chunk_summary(df: DataFrame, scale: int | None = 1, chunk: str = CHUNK) -> DataFrame:
    """Minimum, mean and maximum per chunk and station."""
    temp = one_zero(F.col(TEMP))
    return df.groupBy(chunk, STATION).agg(
        F.min(temp).alias("temp_minimum"),
        exact_mean(temp, scale).alias("temp_mean"),
        F.max(temp).alias("temp_maximum"),
    )


# Chunk means are not bounded in their decimals, so they are summed at this many.
MEAN_SCALE = 12


def mean_of_means(
    summaries: DataFrame, digits: int | None = 1, exact: bool = True
) -> DataFrame:
    """Merge chunk summaries giving every chunk the same weight.

    Differs from the true mean when a station's count differs between chunks.
    Only the mean is rounded. ``exact`` means are taken at twelve decimals before
    they are summed: that is the same for any order, not exact. ``exact=False`` goes with ``scale=None``: means of
    any size, summed as doubles.
    """
    if exact:
        total = F.sum(F.col("temp_mean").cast(f"decimal(28,{MEAN_SCALE})"))
        mean = total.cast("double") / F.count("temp_mean")
    else:
        mean = F.avg("temp_mean")
    merged = summaries.groupBy(STATION).agg(
        F.min("temp_minimum").alias("t_min"),
        mean.alias("t_mean"),
        F.max("temp_maximum").alias("t_max"),
    )
    return merged if digits is None else rounded(merged, digits, ["t_mean"])
