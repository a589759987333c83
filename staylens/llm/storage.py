"""Where operators put the tables between their steps: the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.sources.spread import spread
from staylens.storage import new_path, written

__all__ = ["discard", "new_path", "release", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, dealt to all cores where it is one small file."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def discard(*tables: DataFrame) -> None:
    """Removes tables of written() that nothing reads any more; what was derived from them has to be written by then.

    A collection of the driver's garbage lets Spark remove the shuffle files of the finished steps as well.
    """
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage: Spark removes the shuffle files of steps that nothing refers to any more."""
    spark._jvm.System.gc()
