"""URL filters: a Bloom filter cascade over all hosts of the corpus.

The cascade holds a listed set exactly, for every key of the corpus, in a few
bits a key. Level 1 encodes the listed keys. Level 2 encodes the unlisted keys
that level 1 takes for listed, level 3 the listed ones that level 2 takes for
unlisted, and so on until no key is mistaken. A key belongs to the listed set if
the first level that does not hold it has an even number. Since the levels were
built against the complete universe of keys, this is right for each of them.

Filters are cut into shards by the hash of the key, so that no filter outgrows a
row. Rows look their key up in an array that all tasks share, without a join, as
long as the measured filters stay within ``FILTER_BYTES``; beyond that each row
meets the one shard of its key in an equi-join.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import store
from .common import ascii_lower

HASHES = 5
BITS_PER_KEY = 8
KEYS_PER_SHARD = 1 << 15
FILTER_BYTES = 32 << 20
_WORD = 64


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        at_host = (host == self.host) | host.endswith("." + self.host)
        return at_host & path.startswith(self.path)


@dataclass(frozen=True)
class Cascade:
    """``levels`` has a row ``shard, words`` for each shard, per level."""

    levels: list[DataFrame]
    shards: int
    in_array: bool


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _place(key: Column, level: int, nth: int, bits: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(nth)), bits)


def _holds(words: Column, key: Column, level: int) -> Column:
    """Whether the filter has all bits of the key. An empty one holds nothing."""
    bits = F.greatest(F.size(words), F.lit(1)).cast("bigint") * _WORD
    held = F.size(words) > 0
    for nth in range(HASHES):
        place = _place(key, level, nth, bits)
        word = F.get(words, F.floor(place / _WORD).cast("int"))
        held = held & (F.coalesce(F.getbit(word, F.pmod(place, F.lit(_WORD)).cast("int")), F.lit(0)) == 1)
    return held


def _encode(keys: DataFrame, shards: int, level: int) -> DataFrame:
    """One filter a shard, as an array of 64-bit words, for all shards."""
    spark = keys.sparkSession
    sizes = keys.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / _WORD).alias("n_words"))
    blank = sizes.select("shard", F.explode(F.sequence(F.lit(0), F.col("n_words") - 1)).alias("word"), F.lit(0).cast("bigint").alias("bits"))
    places = F.array(*[_place(F.col("key"), level, nth, F.col("n_words") * _WORD) for nth in range(HASHES)])
    ones = (
        keys.join(sizes, "shard")
        .select("shard", F.explode(places).alias("place"))
        .select(
            "shard",
            F.floor(F.col("place") / _WORD).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(_WORD)).cast("int")).alias("bits"),
        )
    )
    words = (
        blank.unionByName(ones)
        .groupBy("shard", "word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy("shard")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
        .select("shard", F.col("words.bits").alias("words"))
    )
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(words, "shard", "left").select("shard", F.coalesce("words", F.array().cast("array<bigint>")).alias("words"))


def _with_filter(df: DataFrame, cascade: Cascade, level: int, name: str) -> DataFrame:
    """``df`` with the filter of the row's shard."""
    filters = cascade.levels[level - 1]
    if cascade.in_array:
        # One row, of proven size, handed to the tasks as a constant.
        all_of = filters.agg(F.sort_array(F.collect_list(F.struct("shard", "words"))).alias("all"))
        return df.withColumn(name, F.get(all_of.scalar(), F.col("shard"))["words"])
    return df.join(filters.withColumnRenamed("words", name), "shard", "left")


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """The cascade for the keys of ``listed`` within ``universe``; both have a column ``key``.

    Null keys are not listed. Repeated keys count once. Listed keys outside of the
    universe are held too. Without listed keys there are no levels.
    """
    listed = store(listed.select("key").dropna().distinct(), "listed")
    n_listed = listed.count()
    shards = max(1, ceil(n_listed / KEYS_PER_SHARD))
    rest = universe.select("key").dropna().distinct().join(listed, "key", "left_anti")
    with_shard = [store(side.withColumn("shard", _shard(F.col("key"), shards)), "keys") for side in (listed, rest)]
    # Level 1 needs one word for each 8 keys; later levels encode ever fewer keys.
    n_rest = with_shard[1].count()
    most = (max(n_listed, n_rest) * BITS_PER_KEY // 8 + 8 * shards) if n_listed else 0
    in_array = most <= FILTER_BYTES
    cascade = Cascade([], shards, in_array)
    if not n_listed:
        return cascade
    encoded, others = with_shard
    while True:
        level = len(cascade.levels) + 1
        cascade.levels.append(store(_encode(encoded, shards, level), f"filter{level}"))
        mistaken = store(
            _with_filter(others, cascade, level, "words")
            .filter(_holds(F.col("words"), F.col("key"), level))
            .select("key", "shard"),
            "mistaken",
        )
        if mistaken.isEmpty():
            return cascade
        encoded, others = mistaken, encoded


def with_listed(df: DataFrame, key: str, cascade: Cascade, name: str = "listed") -> DataFrame:
    """``df`` with whether the cascade holds the row's key; null keys are not listed."""
    columns = [F.col(f"`{c}`") for c in df.columns if c != name]
    if not cascade.levels:
        return df.select(*columns, F.lit(False).alias(name))
    row = df.select(F.struct(*columns).alias("row"), F.col(key).alias("key"))
    row = row.withColumn("shard", F.coalesce(_shard(F.col("key"), cascade.shards), F.lit(0)))
    verdict = F.lit(len(cascade.levels) % 2 == 1)
    for level in range(len(cascade.levels), 0, -1):
        row = _with_filter(row, cascade, level, f"words{level}")
        held = _holds(F.col(f"words{level}"), F.col("key"), level)
        verdict = F.when(held, verdict).otherwise(level % 2 == 0)
    return row.select("row.*", (verdict & F.col("key").isNotNull()).alias(name))


def filter_urls(pages: DataFrame, rules: list[Rule], cascade: Cascade, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, listed, verdict`` of each URL.

    The longest rule that fits decides; ``rule`` is null where none does, and then
    hosts that the cascade holds are blocked, all others allowed. A null URL, and
    one without ``://``, has an empty host and path and is allowed. Rows keep
    their number and all other columns; columns of the five names are replaced.
    """
    made = ("host", "path", "rule", "listed", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    address = F.coalesce(F.col(url), F.lit(""))
    parsed = pages.select(F.struct(*kept).alias("page"), host_of(address).alias("host"), path_of(address).alias("path"))
    looked_up = with_listed(parsed, "host", cascade)
    by_length = sorted(rules, key=lambda r: -len(r.text))
    rule = F.lit(None).cast("string")
    ruled = F.when(F.col("listed"), "block").otherwise("allow")
    for r in reversed(by_length):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.text).otherwise(rule)
        ruled = F.when(fits, r.verdict).otherwise(ruled)
    return looked_up.select("page.*", "host", "path", rule.alias("rule"), "listed", ruled.alias("verdict"))
