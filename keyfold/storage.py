"""Tables kept in the shared folder that the cluster names.

A stored table cuts lineage and survives the loss of any executor: its data is
in shared storage, not on the machine that computed it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``.

    Only a local master may do without either; it gets a temporary folder.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="keyfold-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/keyfold-{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so later branches do not recompute it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
