"""A result kept as a table that is read by station.

Rows are dealt to buckets by station and sorted within each, one file a bucket.
A join on the station reads the table as it lies, without shuffling it; a single
station is one bucket, and of that the row groups whose range holds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATION
from .keys import distinct_stations

BUCKETS = 64
# Small row groups, since most readers are after a few rows.
ROW_GROUP_BYTES = 8 << 20


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def store_result(
    result: DataFrame, name: str, path: str, buckets: int = BUCKETS, row_group_bytes: int = ROW_GROUP_BYTES
) -> DataFrame:
    """Write ``result`` to ``path``, known as the table ``name`` in this session; returns the table.

    A second run with the same name and path replaces what the first wrote, so it
    may be repeated. ``result`` must not read the table itself. With one row per
    station buckets are even, and a file holds ``1 / buckets`` of the rows.
    """
    dealt = result.repartition(buckets, STATION).sortWithinPartitions(STATION)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer = writer.option("parquet.block.size", row_group_bytes)
    writer.bucketBy(buckets, STATION).sortBy(STATION).saveAsTable(name)
    return result.sparkSession.table(name)


def open_result(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The table that another session stored at ``path``, with the same number of buckets.

    A name that this session knows already is left as it is.
    """
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet "
            f"CLUSTERED BY (`{STATION}`) SORTED BY (`{STATION}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def lookup_stored(names: DataFrame, table: DataFrame) -> DataFrame:
    """The row of a stored table for each different name that it has, in no order.

    Only the names move: to all tasks if they are few, else to the buckets.
    """
    return table.join(distinct_stations(names), STATION)


def row_of(table: DataFrame, station: str) -> DataFrame:
    """The rows of one station. One bucket is opened, and of it the row groups that may have it."""
    return table.filter(F.col(STATION) == F.lit(station))
