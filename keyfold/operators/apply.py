"""A Python function applied to chunks of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import STATION, TEMP
from .partial import CHUNK


def apply_per_chunk(
    df: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
    chunk: str = CHUNK,
) -> DataFrame:
    """Apply ``function`` once to each chunk and concatenate what it returns.

    The function gets an iterator over the batches of one chunk, all of its rows
    and no others, so a chunk need not fit in memory. Rows without a chunk are a
    chunk. One task works on a chunk from end to end: chunks should be many.
    """

    def over_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from function(batches)

    return df.groupBy(chunk).applyInPandas(over_chunk, schema)


def apply_per_batch(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply ``function`` to each Arrow batch and concatenate what it returns.

    Batches are cut from each partition as it is read, with at most
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows, so nothing is shuffled.
    What the function returns must be such that batches can be merged.
    """

    def over_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(over_batches, schema)


BATCH_SCHEMA = f"{CHUNK} BIGINT, {STATION} STRING, t_min DOUBLE, t_max DOUBLE, n BIGINT"
SUMMARY_SCHEMA = (
    f"{CHUNK} BIGINT, {STATION} STRING, temp_minimum DOUBLE, temp_mean DOUBLE, temp_maximum DOUBLE"
)


def group_batch(batch: pd.DataFrame) -> pd.DataFrame:
    """Minimum, maximum and count per chunk and station of one batch; NULL is a key too."""
    grouped = batch.groupby([CHUNK, STATION], as_index=False, dropna=False)[TEMP]
    return _plain_names(grouped.agg(t_min="min", t_max="max", n="count"))


def _plain_names(rows: pd.DataFrame) -> pd.DataFrame:
    """Stations as plain objects: a batch with none but NULL ones has to be text as well."""
    names = rows[STATION].astype(object)
    return rows.assign(**{STATION: names.where(names.notna(), None)})


def merge_batches(batches: DataFrame) -> DataFrame:
    return batches.groupBy(CHUNK, STATION).agg(
        F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"), F.sum("n").alias("n")
    )


def summarize_chunk(scale: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Minimum, mean and maximum per station of one chunk, however it is cut into batches.

    Sums are of whole numbers, so the mean does not depend on the batches.
    """
    unit = 10**scale

    def function(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for batch in batches:
            whole = (batch[TEMP] * unit).round()
            one = pd.DataFrame({CHUNK: batch[CHUNK], STATION: batch[STATION], TEMP: batch[TEMP] + 0.0, "whole": whole})
            grouped = one.groupby([CHUNK, STATION], dropna=False)
            part = grouped.agg(low=(TEMP, "min"), high=(TEMP, "max"), total=("whole", "sum"), n=(TEMP, "count"))
            state = part if state is None else pd.concat([state, part])
            by = state.groupby(level=[CHUNK, STATION], dropna=False)
            state = by.agg({"low": "min", "high": "max", "total": "sum", "n": "sum"})
        if state is not None:
            flat = state.reset_index()
            summary = pd.DataFrame(
                {
                    CHUNK: flat[CHUNK],
                    STATION: flat[STATION],
                    "temp_minimum": flat["low"],
                    "temp_mean": flat["total"] / unit / flat["n"],
                    "temp_maximum": flat["high"],
                }
            )
            yield _plain_names(summary)

    return function
