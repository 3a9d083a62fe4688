"""The extraction run in one call: a folder of filings to tables, a combined table and an outcome for each filing.

``run`` writes, below ``out``: ``prompts``, ``responses`` and ``outcomes`` (Parquet, a row a filing), ``tables`` (a CSV
file with its own header for each filing with a table) and ``combined`` (the outer union of all tables, CSV). Each step is
written before the next reads it, so that a model is asked once for each prompt whatever is lost later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import extraction as ex
from ledgerlens.operators import tables as tb
from ledgerlens.sources import csvio, widecsv
from ledgerlens.sources.filings import filing_files


def run(spark: SparkSession, folder: str, out: str, ask: Callable[[DataFrame], DataFrame], suffix: str = ".txt", recursive: bool = True,
        scorer: str = "ratcliff", max_bytes: int = ex.MAX_BYTES, columns: list[str] | None = None) -> DataFrame:
    """Outcomes of the filings below ``folder``.

    ``ask`` takes ``(filing_id, prompt)`` rows and gives ``(filing_id, response)`` rows, with ``error`` for calls that failed;
    a prompt without a row is an empty answer. Running again replaces what was written.
    """
    def step(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    files = filing_files(spark, folder, suffix, recursive)
    prompts = step(ex.filing_prompts(ex.readable(files, max_bytes), scorer), "prompts")
    asked = prompts.where(F.col("status") == ex.PROMPTED).select("filing_id", "prompt")
    responses = step(ask(asked), "responses")
    outcomes = step(ex.filing_outcomes(prompts, responses), "outcomes")
    widecsv.write_parsed(outcomes, f"{out}/tables")
    parsed = outcomes.where(F.col("status") == tb.STATUS_OK).withColumn("table_no", F.lit(1))
    csvio.write_combined(tb.combine_rows(parsed, columns), f"{out}/combined")
    return outcomes


def counts(outcomes: DataFrame) -> DataFrame:
    """``(status, n)``: how many filings ended in which way."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
