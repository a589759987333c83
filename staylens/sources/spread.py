"""Small tables in few files, dealt to all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df dealt to a few times as many tasks as run at once, where it has fewer files (a row group is the work of one task, and a
    large file may have only one, however many tasks its bytes are cut into).

    A table of many files stays as it is, without a shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(4 * want, df.rdd.getNumPartitions())) if len(df.inputFiles()) < want else df
