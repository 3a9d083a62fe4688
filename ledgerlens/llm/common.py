"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_dir

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` by Spark's reader, whatever store the path names."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs only the tasks of the current
    step, and the reader knows the table's true size when it plans a join. The
    folder belongs to the application and goes with ``clear_scratch``.

    Nothing needs the step's shuffle files any more, but Spark keeps them
    until the driver's garbage is collected; ``release`` asks for that after a
    step that shuffled much.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later step reads: what was made of them has to be written itself."""
    for t in tables:
        _delete(t.sparkSession, t.written_to)


def _folder(spark: SparkSession) -> str:
    return scratch_dir(spark, f"ledgerlens-{spark.sparkContext.applicationId}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application (after its results are written)."""
    _delete(spark, _folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the id filter: 2**24 bits are 2**18 longs, about 4 MB at any input size.
FILTER_BITS = 24


def maybe_in(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids``: a semi-join by a bitmap of fixed size.

    Keeps every row whose key is there (and a few others, so an exact join or
    filter has to follow). The bitmap has at most 2**18 rows whatever the
    input, which is what makes it safe to broadcast; with ever more ids it lets
    more rows pass, never fewer.
    """
    return _bit_joined(df, key, ids, id_col).where(F.col("__hit")).drop("__hit")


def split_by_filter(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``ids``, rows whose key certainly isn't)."""
    marked = _bit_joined(df, key, ids, id_col)
    return marked.where(F.col("__hit")).drop("__hit"), marked.where(~F.col("__hit")).drop("__hit")


def _bit_joined(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    slot = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << FILTER_BITS))
    bits = (ids.select(slot(id_col).alias("s")).groupBy((F.col("s") / 64).cast("int").alias("__word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("__bits")))
    out = (df.withColumn("__slot", slot(key)).withColumn("__word", (F.col("__slot") / 64).cast("int"))
           .join(F.broadcast(bits), "__word", "left"))
    hit = F.coalesce(F.expr("getbit(__bits, cast(__slot % 64 as int)) = 1"), F.lit(False))
    return out.withColumn("__hit", hit).drop("__slot", "__word", "__bits")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns cannot clash with working names."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def null_safe(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))
