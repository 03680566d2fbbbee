"""A Bloom filter of stations, which drops rows of a large table before they are shuffled.

The filter is a table of shards with a fixed number of bits each. A station belongs
to one shard and sets four bits there. The table is broadcast; its size follows the
number of stations and is bounded: beyond the bound a station gets fewer bits, and
too few to be of use mean no filter at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import STATION
from ..storage import store

# Bits of a shard; each of four hashes of 16 bits names one.
SHARD_BITS = 1 << 16
BITS_PER_KEY, LEAST_BITS_PER_KEY = 12, 4
MOST_BYTES = 16 << 20
_HASHES = 4


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64(STATION), F.lit(shards)).cast("int")


def _bits() -> list[Column]:
    place = F.xxhash64(STATION, F.lit(1))
    return [F.shiftrightunsigned(place, 16 * i).bitwiseAND(F.lit(SHARD_BITS - 1)).cast("int") for i in range(_HASHES)]


def station_filter(stations: DataFrame, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, int] | None:
    """The filter of a table of different stations and its number of shards; None if it would be too large."""
    n = stations.count()
    per_key = min(BITS_PER_KEY, 8 * most_bytes // max(1, n))
    if per_key < LEAST_BITS_PER_KEY:
        return None
    shards = max(1, -(-n * per_key // SHARD_BITS))
    bit = F.explode(F.array(*_bits())).alias("bit")
    bits = stations.filter(F.col(STATION).isNotNull()).select(_shard(shards).alias("_shard"), bit)
    one = F.expr("shiftleft(1L, bit & 63)")
    words = bits.groupBy("_shard", F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    every = F.sequence(F.lit(0), F.lit(SHARD_BITS // 64 - 1))
    filled = words.groupBy("_shard").agg(by_word.alias("words"))
    filled = filled.select("_shard", F.transform(every, lambda i: F.coalesce(F.col("words")[i], F.lit(0).cast("bigint"))).alias("_words"))
    return store(filled, "filter"), shards


def gate_stations(df: DataFrame, stations: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df`` without most of the rows whose station is not among ``stations``.

    No row of a station among them is lost. Rows without a station may go.
    """
    made = station_filter(stations, most_bytes)
    if made is None:
        return df
    table, shards = made
    joined = df.withColumn("_shard", _shard(shards)).join(F.broadcast(table), "_shard")
    for bit in _bits():
        word = F.get("_words", F.shiftright(bit, 6))
        joined = joined.filter(F.getbit(word, bit.bitwiseAND(F.lit(63))) == 1)
    return joined.drop("_shard", "_words")
