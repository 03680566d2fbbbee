"""All values of a station as lists.

A list per station would put every row of a hot station into one array in one
task. A station's list is therefore kept in parts: the values of one chunk of
the input each. A chunk has a fixed number of rows, or ``most`` bounds a list, so
a part has at most as many, whatever the station. The parts together hold every
value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_list_sum, one_zero, whole_part
from ..schema import STATION, TEMP
from ..storage import store
from .partial import CHUNK, merge_state

ROWS_PER_CHUNK = 1 << 16


def number_chunks(df: DataFrame, row_number: str, rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``chunk``: the next ``rows`` row numbers at a time. They must be unique."""
    return df.withColumn(CHUNK, whole_part(F.col(row_number), rows))


def group_to_list(
    df: DataFrame, chunk: str = CHUNK, most: int | None = None
) -> DataFrame:
    """``station, chunk, temps``: the sorted values of a station in one chunk.

    Chunks of ``number_chunks`` bound a list by themselves. For any other chunk,
    ``most`` does: a station with more rows in a chunk has several lists there, each
    of at most about ``most`` values and none lost. Equal values are counted before
    anything else, and a count is dealt out in pieces, each by its value and number.
    So the list a value goes to depends on the data alone, however rows are ordered
    and whichever task is run again, and a value that fills a station is spread.
    Zero has no sign then.
    """
    if most is None:
        lists = df.groupBy(STATION, chunk).agg(F.sort_array(F.collect_list(TEMP)).alias("temps"))
        return lists.select(STATION, chunk, "temps")
    keys = [STATION, chunk]
    counted = store(df.groupBy(*keys, TEMP).agg(F.count(F.lit(1)).alias("_n")), "values")
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_rows")).filter(F.col("_rows") > most)
    large = store(sizes.select(*keys, F.ceil(2 * F.col("_rows") / most).alias("_parts")), "large")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    found = counted.alias("d").join(large.alias("l"), same, "left").select("d.*", F.coalesce("_parts", F.lit(1)).alias("_parts"))
    piece = max(1, most // 64)
    cut = F.when(F.col("_parts") == 1, F.lit(1)).otherwise(F.ceil(F.col("_n") / piece))
    pieces = found.withColumn("_cut", cut).withColumn("_piece", F.explode(F.sequence(F.lit(1), F.col("_cut").cast("bigint"))))
    last = F.col("_piece") == F.col("_cut")
    size = F.when(last, F.col("_n") - (F.col("_cut") - 1) * piece).otherwise(piece).cast("int")
    part = F.pmod(F.xxhash64(TEMP, "_piece"), F.col("_parts"))
    dealt = pieces.select(*keys, part.alias("_part"), F.struct(F.col(TEMP).alias("temp"), size.alias("n")).alias("_some"))
    values = F.flatten(F.transform(F.collect_list("_some"), lambda x: F.array_repeat(x["temp"], x["n"])))
    lists = dealt.groupBy(*keys, "_part").agg(values.alias("temps"))
    return lists.select(*keys, F.sort_array(F.filter("temps", lambda x: x.isNotNull())).alias("temps"))


def merge_lists(lists: DataFrame, fan_in: int = 8, chunk: str = CHUNK) -> DataFrame:
    """Concatenate the lists of ``fan_in`` consecutive chunks per station.

    Chunks are numbers here. The longest list grows by at most ``fan_in`` times.
    """
    wider = whole_part(F.col(chunk), fan_in)
    return (
        lists.withColumn(chunk, wider)
        .groupBy(STATION, chunk)
        .agg(F.sort_array(F.flatten(F.collect_list("temps"))).alias("temps"))
    )


def list_state(lists: DataFrame, scale: int | None = 1) -> DataFrame:
    """Reduce each list to ``t_min, t_sum, t_max, n``."""
    temps = F.col("temps")
    return lists.select(
        STATION,
        one_zero(F.array_min(temps)).alias("t_min"),
        exact_list_sum(temps, scale).alias("t_sum"),
        one_zero(F.array_max(temps)).alias("t_max"),
        F.size(temps).cast("bigint").alias("n"),
    )


def list_summary(lists: DataFrame, scale: int | None = 1, digits: int | None = 1) -> DataFrame:
    """Minimum, mean and maximum over all lists of a station; ``digits=None`` leaves them unrounded."""
    return merge_state(list_state(lists, scale), digits)
