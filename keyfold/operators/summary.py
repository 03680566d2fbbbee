"""Minimum, mean and maximum per station.

Everything is algebraic: each task folds its rows into one state per station
before the shuffle, so a station holding a third of all rows adds one row per
task to the exchange and no more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, one_zero, round_half_even
from ..schema import STATION, TEMP

RESULT = ("t_min", "t_mean", "t_max")


def summarize(
    df: DataFrame,
    by: str | Sequence[str],
    specs: Sequence[tuple[str, str | Callable[[Column], Column], str]],
) -> DataFrame:
    """Aggregates stated as ``(column, function, output name)``.

    The function is the name of one in ``pyspark.sql.functions`` or a callable
    from a column to an aggregate.
    """
    keys = [by] if isinstance(by, str) else list(by)
    aggregates = []
    for column, function, name in specs:
        call = getattr(F, function) if isinstance(function, str) else function
        aggregates.append(call(F.col(column)).alias(name))
    return df.groupBy(*keys).agg(*aggregates)


def station_stats(df: DataFrame, scale: int | None = 1) -> DataFrame:
    """``station, t_min, t_mean, t_max``, unrounded and in no order.

    ``scale`` is the number of decimals in ``temp``.
    """
    return summarize(
        df,
        STATION,
        [
            (TEMP, lambda temp: F.min(one_zero(temp)), "t_min"),
            (TEMP, lambda temp: exact_mean(temp, scale), "t_mean"),
            (TEMP, lambda temp: F.max(one_zero(temp)), "t_max"),
        ],
    )


def rounded(stats: DataFrame, digits: int = 1, columns: Sequence[str] = RESULT) -> DataFrame:
    return stats.withColumns({name: round_half_even(F.col(name), digits) for name in columns})


def station_summary(df: DataFrame, scale: int | None = 1, digits: int = 1) -> DataFrame:
    """The summary with all three numbers rounded, sorted by station."""
    return rounded(station_stats(df, scale), digits).orderBy(STATION)


def round_mean_only(df: DataFrame, scale: int | None = 1, digits: int = 1) -> DataFrame:
    """The summary with minimum and maximum left as they are."""
    return rounded(station_stats(df, scale), digits, ["t_mean"]).orderBy(STATION)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
