"""Sets of stations, and joins on the station."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..schema import STATION
from ..storage import store
from .gate import MOST_BYTES as GATE_BYTES
from .gate import gate_stations

BROADCAST_BYTES = 32 << 20
# A station with more rows than this is spread, so that no task gets many more.
ROWS_PER_TASK = 4_000_000
# Stations are counted on a sample of about so many bytes. The counts only choose
# how rows are dealt out; all rows are joined whatever they say.
COUNTED_BYTES = 4 << 30
# The optimizer's word for a size it does not know is near the largest integer.
UNKNOWN_BYTES = 1 << 60
# Rows without a station meet nothing, so they may go anywhere.
NULL_SALTS = 64


def distinct_stations(df: DataFrame) -> DataFrame:
    return df.select(STATION).distinct()


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def union_distinct_stations(tables: Sequence[DataFrame]) -> DataFrame:
    return union_tables([t.select(STATION) for t in tables]).distinct()


def filter_station(df: DataFrame, station: str) -> DataFrame:
    return df.filter(F.col(STATION) == station)


_FIXED_WIDTH = (BooleanType, NumericType, DateType, TimestampType, TimestampNTZType)


def _stored_bytes(df: DataFrame) -> int:
    """Upper estimate of what a broadcast of ``df`` holds in memory."""
    size = F.lit(64)
    for field in df.schema:
        if isinstance(field.dataType, _FIXED_WIDTH):
            size = size + 32
        else:
            text = F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
            size = size + text * (1 if isinstance(field.dataType, StringType) else 4)
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes for the size of ``df``; no job runs for it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _counted_part(df: DataFrame) -> tuple[DataFrame, float]:
    """``df`` or a sample of it of about ``COUNTED_BYTES``, and its share."""
    size = estimated_bytes(df)
    fraction = 1.0 if size >= UNKNOWN_BYTES else min(1.0, COUNTED_BYTES / max(1, size))
    return (df.sample(fraction, seed=1) if fraction < 1 else df), fraction


def station_salts(
    df: DataFrame, rows_per_task: int = ROWS_PER_TASK, salts: int | None = None
) -> DataFrame:
    """``station, salts`` for each station of more than ``rows_per_task`` rows.

    ``salts`` is about the rows over ``rows_per_task``, or as given. Only the
    station is read, and of a large table only a sample of its rows counts.
    """
    stations, fraction = _counted_part(df.select(STATION).filter(F.col(STATION).isNotNull()))
    needed = F.ceil(F.count(F.lit(1)) / (fraction * rows_per_task))
    counted = stations.groupBy(STATION).agg(needed.alias("_salts")).filter("_salts > 1")
    given = F.col("_salts") if salts is None else F.lit(salts).cast("bigint")
    return store(counted.select(STATION, given.alias("_salts")), "salts")


_JOINS = {
    "inner": "inner", "left": "left", "left_outer": "left", "leftouter": "left",
    "left_semi": "left_semi", "leftsemi": "left_semi", "semi": "left_semi",
    "left_anti": "left_anti", "leftanti": "left_anti", "anti": "left_anti",
    "right": "right", "right_outer": "right", "rightouter": "right",
    "outer": "full", "full": "full", "full_outer": "full", "fullouter": "full",
}


def join_on_station(
    df: DataFrame,
    keyed: DataFrame,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    salts: int | None = None,
    salt_on: str | None = None,
    gate_bytes: int = GATE_BYTES,
) -> DataFrame:
    """Join ``df`` to a table with one row per station; any type of join but cross.

    ``keyed`` is stored, which computes it once and tells its size. Up to
    ``broadcast_bytes`` it is broadcast and ``df`` is not shuffled. Beyond that
    both sides are shuffled by station and salt. A station of more than
    ``rows_per_task`` rows gets as many salts as that takes (or ``salts``), its
    row in ``keyed`` is repeated for each, and all others have salt 0.

    Before that, a Bloom filter of the stations of ``keyed``, of ``gate_bytes`` at
    most, drops rows of ``df`` that a join without need of them would drop anyway
    (inner, semi and right); 0 is no filter.

    The salt follows the hash of a row's columns, or of ``salt_on``, so a task run
    twice places its rows alike. Rows of a hot station that are alike in all columns
    and more than ``rows_per_task`` are counted, and as counts they are dealt evenly
    to the salts. The salted join finds the rows of ``df`` with
    their match; in a right or full join, the rows of ``keyed`` whose station
    ``df`` does not have come from a step of their own. So the size decides how
    rows move and not which come out.
    """
    if how not in _JOINS:
        raise ValueError(f"no join of type {how!r}; one of {sorted(set(_JOINS.values()))}")
    how = _JOINS[how]
    keyed = store(keyed, "keyed")
    if _stored_bytes(keyed) <= broadcast_bytes:
        return df.join(F.broadcast(keyed), STATION, how)
    if gate_bytes and how in ("inner", "left_semi", "right"):
        df = gate_stations(df, keyed.select(STATION), gate_bytes)
    if how in ("right", "full"):
        joined = _salted_join(df, keyed, "inner" if how == "right" else "left", rows_per_task, salts, salt_on)
        unmet = keyed.join(distinct_stations(df), STATION, "left_anti")
        return joined.unionByName(unmet, allowMissingColumns=True)
    return _salted_join(df, keyed, how, rows_per_task, salts, salt_on)


def _salted_join(df, keyed, how, rows_per_task, salts, salt_on) -> DataFrame:
    hot = station_salts(df, rows_per_task, salts)
    if _stored_bytes(hot) <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    salted = salted_rows(df, hot, rows_per_task, salt_on)
    every_salt = F.sequence(F.lit(0), (F.coalesce("_salts", F.lit(1)) - 1).cast("int"))
    repeated = keyed.join(hot, STATION, "left").withColumn("_salt", F.explode(every_salt)).drop("_salts")
    joined = salted.join(repeated, [STATION, "_salt"], how).drop("_salt")
    if "_copies" in joined.columns:
        joined = joined.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return joined.drop("_copies")


def salted_rows(df: DataFrame, hot: DataFrame, rows_per_task: int, salt_on: str | None = None) -> DataFrame:
    """``df`` with ``_salt``; with ``_copies`` too if there are equal rows that a salt by hash would not spread."""
    row = [salt_on] if salt_on else df.columns
    spread = F.when(F.col(STATION).isNull(), NULL_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    placed = df.withColumn("_place", F.xxhash64(*row))
    by_hash = F.pmod("_place", spread).cast("int").alias("_salt")
    repeated = _repeated_rows(placed, hot, rows_per_task)
    if repeated is None:
        return placed.join(hot, STATION, "left").select(*df.columns, by_hash)
    key = [STATION, "_place"]
    # Rows without a station are no repeated rows, and an anti join keeps them.
    single = placed.join(repeated, key, "left_anti").join(hot, STATION, "left")
    single = single.select(*df.columns, by_hash, F.lit(1).cast("bigint").alias("_copies"))
    counted = placed.join(repeated, key, "left_semi").groupBy(*df.columns, "_place").agg(F.count(F.lit(1)).alias("_n"))
    dealt = counted.join(hot, STATION).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)))
    salt = F.pmod(F.pmod("_place", F.col("_salts")) + F.col("_i"), F.col("_salts")).cast("int")
    share = F.floor(F.col("_n") / F.col("_salts")) + F.when(F.col("_i") < F.col("_n") % F.col("_salts"), 1).otherwise(0)
    many = dealt.select(*df.columns, salt.alias("_salt"), share.cast("bigint").alias("_copies")).filter("_copies > 0")
    return single.unionByName(many)


def _repeated_rows(placed: DataFrame, hot: DataFrame, rows_per_task: int) -> DataFrame | None:
    """Station and hash of rows that are repeated more than ``rows_per_task`` times; None if there are none.

    Rows are counted on a sample, as stations are. A table with a map column has
    none, since such rows cannot be counted.
    """
    if any("map<" in f.dataType.simpleString() for f in placed.schema) or not hot.head(1):
        return None
    part, fraction = _counted_part(placed.select(STATION, "_place"))
    counts = part.join(hot.select(STATION), STATION, "left_semi").groupBy(STATION, "_place").count()
    found = store(counts.filter(F.col("count") > fraction * rows_per_task).select(STATION, "_place"), "repeated")
    if not found.head(1):
        return None
    return F.broadcast(found) if _stored_bytes(found) <= BROADCAST_BYTES else found


def keep_stations(df: DataFrame, keys: DataFrame, **how_to_join) -> DataFrame:
    """The rows whose station is among ``keys``."""
    return join_on_station(df, distinct_stations(keys), "left_semi", **how_to_join)


def drop_stations(df: DataFrame, keys: DataFrame, **how_to_join) -> DataFrame:
    """The rows whose station is not among ``keys``."""
    return join_on_station(df, distinct_stations(keys), "left_anti", **how_to_join)


def keys_join_partials(keys: DataFrame, partials: DataFrame, **how_to_join) -> DataFrame:
    """The per-chunk rows of each key; keys and chunks without a match yield none."""
    return join_on_station(partials, distinct_stations(keys), "inner", **how_to_join)


def lookup(names: DataFrame, result: DataFrame, **how_to_join) -> DataFrame:
    """The row of ``result`` for each different name, sorted by name."""
    return join_on_station(distinct_stations(names), result, "inner", **how_to_join).orderBy(STATION)
