"""Stage results that later stages read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder where that is unset, which only a local master may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (folder or tempfile.mkdtemp(prefix="spark-", dir="/tmp")).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of its own in the shared folder, of which readers take the columns they need. It stays there."""
    path = f"{shared_folder(df.sparkSession)}/stages/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> DataFrame:
    """df, computed once into the folder of spark.checkpoint.dir, so that lost executors or later stages don't compute it anew.

    Where that is unset, which only a local master may do without, the folder is a temporary one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
