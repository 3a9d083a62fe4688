"""A written dataset with a length and items by index (TRN2).

Rows are written in index order, ``FILE_ROWS`` to a file, with their place in ``idx``; beside them lies a manifest of one
row a file: its name, first index and rows, and the rows' schema. The length is a sum over the manifest, and an item opens the one
file that holds it; neither scans the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators.trainprep import global_row_number

FILE_ROWS = 100_000


def write_dataset(rows: DataFrame, path: str, order: list[Column], file_rows: int = FILE_ROWS) -> None:
    """Write ``rows`` in ``order`` (which has to tell rows apart), then the manifest."""
    numbered = global_row_number(rows, order, "idx").withColumn("idx", F.col("idx") - 1)
    block = F.floor(F.col("idx") / file_rows).cast("long")
    (numbered.withColumn("block", block).repartition("block").sortWithinPartitions("block", "idx")
     .write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows"))
    spark = rows.sparkSession
    spark.createDataFrame([(numbered.schema.json(),)], "schema string").write.mode("overwrite").text(f"{path}/schema")
    files = spark.read.schema(numbered.schema).parquet(f"{path}/rows")
    (files.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))
     .repartitionByRange(1, "first").write.mode("overwrite").parquet(f"{path}/manifest"))


class IndexedDataset:
    """``len(ds)``, ``ds[i]`` and ``ds.items(indices)`` of what ``write_dataset`` wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifest = spark.read.schema("file string, first long, n long").parquet(f"{path}/manifest")
        self.schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))

    def __len__(self) -> int:
        return self.manifest.agg(F.sum("n")).first()[0] or 0

    def files(self, indices: Iterable[int]) -> list[str]:
        """The files that hold these indices (the manifest is searched by a filter, not collected)."""
        asked = sorted(set(indices))
        if not asked:
            return []
        wanted = self.spark.createDataFrame([(i,) for i in asked], "idx long")
        hit = (F.col("idx") >= F.col("first")) & (F.col("idx") < F.col("first") + F.col("n"))
        return [r.file for r in self.manifest.join(F.broadcast(wanted), hit, "left_semi").select("file").collect()]

    def items(self, indices: Iterable[int]) -> DataFrame:
        """Rows of the indices that exist, from their files alone."""
        asked = sorted(set(indices))
        files = self.files(asked)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files).where(F.col("idx").isin(asked))

    def __getitem__(self, index: int):
        n = len(self)
        found = self.items([index + n if index < 0 else index]).collect() if -n <= index < n else []
        if not found:
            raise IndexError(f"index {index} of a dataset of {n}")
        return found[0]
