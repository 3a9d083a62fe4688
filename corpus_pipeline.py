"""The training-data pipeline over ``documents``: five stages, each one operator.

1. quality rules: documents that the rules reject go;
2. line dedup: repeated and similar lines go, and documents of which nothing is left;
3. n-gram Jaccard join: of each group of similar documents the one with the least id stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. BPE encoding and decoding: ids, their count and digests for each document.

Each stage reads what its predecessor wrote. All but the last return the columns
of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, fuzzy_lines, outliers, partenum, registry, tiling
from ledgerlens.llm.common import WORD, read, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _documents(outliers.kept_rows(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those left without a word go."""
    out = fuzzy_lines.dedup(_documents(docs)).where(F.col("text").rlike(WORD))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _documents(out.withColumn("n_chars", n_chars))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    gone = partenum.classes(docs).where(F.col("id") != F.col("comp")).select(F.col("id").alias("doc_id")).distinct()
    return _documents(docs.join(written(gone, "similar"), "doc_id", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = tiling.find(_documents(docs), read(spark, sf_dir, "benchmark"))
    return _documents(found.where(F.size("found") == 0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document with digests of the ids and of the text decoded from them."""
    return bpe.encode(docs, public_tokenizers.path(registry.VOCABULARY), with_decoded=False)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_join),
          ("benchmark decontamination", decontaminate), ("BPE encoding and decoding", encode)]

#: Robust estimates, similarity components and tiling are not SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
