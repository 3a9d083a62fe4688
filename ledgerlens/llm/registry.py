"""Queries ``opN_<name>`` of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (bpe, fuzzy_lines, html_extract, oracle, outliers, partenum, pii, prefix_trie, quality_model, secret_scan,
                            substrings, tiling, token_counts, vector_codes)
from ledgerlens.llm.common import read

#: The vocabulary file of the BPE operator.
VOCABULARY = "word_bpe_49k.json"


#: The ranks of the token counts.
RANKS = "byte_bpe_50k.tiktoken"
#: The key of the surrogates; a deployment gives its own.
PII_KEY = b"ledgerlens-test-key"
#: Score from which a document is predicted to be good.
GOOD = 0.3


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score",
                         F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.find(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("found") > 0).alias("contaminated"),
                        F.get("found", F.lit(0))["item"].alias("item_id"),
                        F.get("found", F.lit(0))["coverage"].alias("coverage"), F.col("found.item").alias("item_ids"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = partenum.classes(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all texts, then three edits of each: a header put in front, the middle rewritten, a footer added."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n = F.length(F.coalesce("text", F.lit("")))
    middle = (n / 2).cast("int")
    edit = lambda a, b, t: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), t.alias("text"))
    edits = F.array(edit(n, n, F.concat(F.lit("\n"), F.coalesce("source", F.lit("")))),
                    edit(middle, middle + 24, F.lit(" it's rewritten, in 2 words ")),
                    edit(F.lit(0), F.lit(0), F.concat(F.lit("["), F.coalesce("lang", F.lit("")), F.lit("] "))))
    ranks = public_tokenizers.path(RANKS)
    out = token_counts.build_and_edit(docs.withColumn("edits", edits), ranks, public_tokenizers.PATTERN, with_tree=False)
    return out.select("doc_id", "edited.n_before", "edited.n_tokens", "edited.n_pieces", "edited.n_encoded")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.replace(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.withColumn("n_entities", sum((F.col(f"n_{k}") for k in pii.KINDS), F.lit(0)).cast("long"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.judge(read(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "distance")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False, with_decoded=False)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(read(spark, sf_dir, "documents")))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.sequences(read(spark, sf_dir, "conversations"))).withColumnRenamed("sha", "ends_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                        F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extract, op2_quality_classifier, op3_decontaminate, op4_ngram_join,
                                   op5_token_counts, op6_pii, op7_quality_rules, op8_line_dedup, op9_bpe, op10_secret_scan,
                                   op11_substring_dedup, op12_prefix_trie, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    """SQL where SQL can express the operator; the others are held against plain Python in the tests."""
    return {"op4_ngram_join": oracle.ngram_join(), "op8_line_dedup": oracle.line_dedup(), "op10_secret_scan": oracle.secret_scan(),
            "op11_substring_dedup": oracle.substring_dedup(), "op12_prefix_trie": oracle.prefix_trie(),
            "op13_vector_codes": oracle.vector_codes()}
