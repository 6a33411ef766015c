"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession) -> str:
    """A fresh path under spark.checkpoint.dir; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there and a lost executor loses nothing.  No file has more than file_rows rows (0: any number)."""
    path = new_path(df.sparkSession)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
