"""Incremental filing processing (SRC6) with Structured Streaming.

Filings arrive as files in dated folders; the same row-local plan as the
batch job runs on each new file exactly once. The query is stateless (no
aggregation, so no watermark), checkpointed in a folder of the cluster's
checkpoint area, and can run continuously or as ``availableNow`` catch-up.

``start_extraction`` is the whole front of the run, TXT1 to TXT7. Each micro-batch is one
write into a folder of its own, ``{sink}/batch_id=N``, split by ``outcome`` into results and
dead letters. The offset log fixes which files batch N has, so a batch that is run again after a
crash overwrites its folder with the same rows: a kill before, during or after the write loses
and doubles nothing. ``outcomes`` reads the batches whose write was committed.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions import text as tx
from ledgerlens.operators import extraction as ex
from ledgerlens.operators import filings as fo
from ledgerlens.sources.filings import filing_files, relative_id


def filing_stream(spark: SparkSession, path: str, suffix: str = ".txt",
                  max_files_per_trigger: int = 1000, recursive: bool = True) -> DataFrame:
    """Streaming ``(filing_id, path, html)``: one row per new file."""
    df = (spark.readStream.format("text").option("wholetext", True)
          .option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", recursive)
          .option("maxFilesPerTrigger", max_files_per_trigger).load(path))
    return df.select(relative_id(path).alias("filing_id"),
                     F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def start(spark: SparkSession, path: str, sink: str, checkpoint: str,
          plan: Callable[[DataFrame], DataFrame] | None = None,
          available_now: bool = True) -> StreamingQuery:
    """Run ``plan`` over new filings into a parquet sink (exactly once via
    the checkpoint); ``available_now`` processes what exists and stops."""
    src = filing_stream(spark, path)
    out = (plan or summary_plan)(src)
    w = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.outputMode("append").start()


def summary_plan(filings: DataFrame) -> DataFrame:
    """Default per-filing plan, one projection (no join, no state):
    text -> cik, filing date, number of text lines, best header line."""
    t = fo.html_to_text(filings).select("filing_id", "path", tx.clean_lines("text").alias("lines"), "text")
    fields = fo.fields_struct("text")
    return t.select("filing_id", "path", fields["cik"].alias("cik"), fields["date"].alias("filing_date"),
                    F.size("lines").cast("long").alias("n_lines"))


RESULT, DEAD_LETTER = "result", "dead_letter"


def prompt_plan(files: DataFrame) -> DataFrame:
    """The default plan of a micro-batch, row-local: readable text, then TXT1 to TXT7."""
    return ex.filing_prompts(ex.readable(files))


def write_batch(out: DataFrame, sink: str, batch_id: int) -> None:
    """Results and dead letters of one micro-batch, in one job; running it again replaces them."""
    outcome = F.when(F.col("status").isin(*ex.DEAD), F.lit(DEAD_LETTER)).otherwise(F.lit(RESULT))
    (out.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome")
     .parquet(f"{sink.rstrip('/')}/batch_id={batch_id}"))


LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def lookup_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that looks up given files in a task a core.

    The source of a stream looks up the files of each micro-batch again, by default in a task for each file, which takes longer
    than reading them. It goes by the settings of the session that the stream was read with.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(LOOKUP_TASKS, str(max(spark.sparkContext.defaultParallelism, 1)))
    return own


def start_extraction(spark: SparkSession, path: str, sink: str, checkpoint: str,
                     plan: Callable[[DataFrame], DataFrame] = prompt_plan, suffix: str = ".txt",
                     max_files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Run ``plan`` (files -> rows with a ``status``) over each new file below ``path``."""
    files = filing_files(lookup_session(spark), path, suffix, max_files_per_trigger=max_files_per_trigger)
    w = (files.writeStream.foreachBatch(lambda batch, batch_id: write_batch(plan(batch), sink, batch_id))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def outcomes(spark: SparkSession, sink: str, outcome: str | None = None) -> DataFrame | None:
    """Rows of the committed batches (``RESULT`` or ``DEAD_LETTER`` alone if asked), or None while there is none.

    A batch counts once its write left the ``_SUCCESS`` marker; what a killed write leaves is not read.
    """
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}/batch_id=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    batches = [f.getPath().getParent().toString() for f in found or []]
    if not batches:
        return None
    df = (spark.read.option("basePath", sink).schema(f"{_OUTCOME}, batch_id long, outcome string").parquet(*batches))
    return df if outcome is None else df.where(F.col("outcome") == outcome)


_OUTCOME = ("filing_id string, path string, status string, reason string, cik string, filing_date string, n_lines long, "
            "best_pos long, best_score double, prompt string")
