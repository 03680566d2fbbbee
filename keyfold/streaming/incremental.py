"""The summary kept up to date over arriving files.

State is one row per station, so it needs no watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.summary import RESULT, station_stats
from ..schema import STATION
from ..sources.delimited import parse_lines


def incremental_stats(
    spark: SparkSession,
    path: str,
    scale: int | None = 1,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Streaming ``station, t_min, t_mean, t_max`` over the text files of a folder.

    ``max_files`` or ``max_bytes`` bounds a batch.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return station_stats(parse_lines(reader.text(path)), scale)


# State on local disk beside the heap, saved to the checkpoint as what changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_available(stats: DataFrame, table: str, checkpoint: str, mode: str = "update") -> list[dict]:
    """Fold in all files that are there, then stop. Run it again when more have come.

    State is kept in RocksDB, so it may outgrow the memory of the executors, and each
    batch saves only what changed of it. A run goes on from what ``checkpoint`` has,
    whether the one before it came to its end or was stopped. Returns the progress
    of the batches.

    Each batch goes to a folder of its own below ``table``; a batch that is run
    again after a failure replaces it. ``update`` writes the stations that
    changed and suits many stations; ``complete`` writes all of them every time.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = stats.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # A query keeps the settings that hold when it starts.
    with _with_settings(stats.sparkSession, STATE):
        query = writer.foreachBatch(write_batch).start()
    query.awaitTermination()
    return list(query.recentProgress)


def _batches(spark: SparkSession, table: str) -> DataFrame:
    schema = f"{STATION} STRING, " + ", ".join(f"{c} DOUBLE" for c in RESULT) + ", batch BIGINT"
    return spark.read.schema(schema).parquet(table)


def compact(spark: SparkSession, table: str, into: str) -> None:
    """Write the newest row of every station of ``table`` as one batch of a new table.

    Later runs with ``into`` as their table go on from there, and ``latest_stats``
    reads one row per station in place of all that was ever written. ``table``
    stays as it is.
    """
    newest = _batches(spark, table).agg(F.max("batch")).first()[0]
    if newest is not None:
        latest_stats(spark, table).write.mode("overwrite").parquet(f"{into}/batch={newest}")


def latest_stats(spark: SparkSession, table: str, mode: str = "update") -> DataFrame:
    """The newest row of every station.

    In ``complete`` mode every batch has all stations and only the newest is read.
    In ``update`` mode all batches are, as any may hold a station's newest row;
    ``compact`` keeps them few.
    """
    batches = _batches(spark, table)
    if mode == "complete":
        # Folder names alone tell which batch is the newest.
        newest = batches.agg(F.max("batch")).first()[0]
        return batches.filter(F.col("batch") == F.lit(newest)).select(STATION, *RESULT)
    numbers = F.struct(*RESULT)
    return (
        batches.groupBy(STATION)
        .agg(F.max_by(numbers, "batch").alias("newest"))
        .select(STATION, "newest.*")
    )
