"""Parquet table access for the driver's data folders."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: A scan of fewer splits than this is dealt to all cores.
FEW_SPLITS = 8


def table(spark: SparkSession, sf_dir: str, name: str, rows_per_task: int | None = None) -> DataFrame:
    """``spark.read.parquet`` of ``{sf_dir}/{name}.parquet``.

    Column pruning and filter pushdown happen at this scan (callers select
    only what they use). A table of fewer than ``FEW_SPLITS`` splits, at
    most a file or two, is dealt to all cores, because one row group is one
    task; anything larger is read as it lies. For costly work on each row
    ``rows_per_task`` deals it to tasks of about that many rows, which then
    do not grow with the table (the rows are counted from the files' footers).
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    cores, splits = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    tasks = cores if splits < min(FEW_SPLITS, cores) else splits
    if rows_per_task:
        tasks = max(tasks, -(-df.count() // rows_per_task))
    return df.repartition(tasks) if tasks > splits else df
