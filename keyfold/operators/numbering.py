"""Row numbers in sort order without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import store

# monotonically_increasing_id() puts the partition above 33 bits of position.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order_by: str, name: str = "row_no") -> tuple[DataFrame, int]:
    """``df`` with consecutive numbers from 0 in the order of a column, and the row count.

    Sorted partitions are stored with the place of each row. What is summed up
    in one task after that is one count per partition.
    """
    place = F.monotonically_increasing_id()
    placed = store(
        df.orderBy(order_by).select(
            "*",
            F.shiftright(place, _POSITION_BITS).alias("_part"),
            place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
        ),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    numbered = (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )
    return numbered, placed.count()
