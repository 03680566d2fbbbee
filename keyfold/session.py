"""Session settings the operators are meant to run under.

On a cluster the session comes from the cluster; ``local_session`` is for
tests, the bench and trying things out on one machine.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Worth setting on a cluster too. AQE coalesces small shuffle partitions and
# splits skewed join partitions; RocksDB keeps streaming state off the heap
# when there are many stations.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "keyfold") -> SparkSession:
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        # Lets a file of a few megabytes be read by all cores.
        .config("spark.sql.files.openCostInBytes", "1m")
    )
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
