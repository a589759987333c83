"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where it is unset and all runs on this machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.gettempdir()}/staylens-checkpoints"
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, compression: str | None = None) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there and lost executors do not matter. The codec is the session's,
    if none is given."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table
