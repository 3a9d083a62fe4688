"""Training-data preparation over column documents (TRN1-TRN6).

tokenise + truncate -> vocabulary ids -> per-epoch seeded shuffle ->
batches -> padding to the batch maximum, with labels = ids (padding
included, as the fine-tuning loop does).

Global orders (vocabulary ranks, shuffle positions) never go through one
task: ``global_row_number`` range-partitions, sorts inside partitions and
adds per-partition offsets (the ``zipWithIndex`` scheme, in DataFrames).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import hash_key
from ledgerlens.functions.text import with_once
from ledgerlens.operators.dictionary import DICTIONARY_BYTES, freeze
from ledgerlens.operators.vectors import tokens
from ledgerlens.session import ensure_checkpoint_dir

# --- fixed values: fine-tuning defaults -------------------------------------
MAX_LENGTH = 1024
BATCH_SIZE = 2
EPOCHS = 1
PAD_ID = 0
UNKNOWN_ID = -1
#: Documents that share a dictionary where the vocabulary is no frozen one, and tokens that are looked up at a time.
CHUNK_DOCS, CHUNK_TOKENS = 8_192, 1 << 20
# --------------------------------------------------------------------------


def global_row_number(df: DataFrame, order: list[Column], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in ``order`` without a single-task sort.

    Rows are range-partitioned on ``order`` and sorted inside partitions;
    partition ``p`` then starts at the total size of partitions ``< p``. The
    sorted rows are checkpointed (to the cluster's checkpoint folder) so the
    ids stay fixed even if a stage is recomputed after an executor loss.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint())
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (s.join(F.broadcast(offs.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))
            .drop("_pid", "_mid", "_m0", "_off"))


def vocabulary(docs: DataFrame, text_col: str = "text", max_length: int = MAX_LENGTH,
               first_id: int = PAD_ID + 1) -> DataFrame:
    """``(token, freq, token_id)``: ids by frequency (desc) then token, from
    ``first_id`` (id 0 is the pad id). Counting is a partial aggregation;
    ranking uses ``global_row_number``."""
    toks = docs.select(F.explode(tokens(F.col(text_col), max_length)).alias("token"))
    freq = toks.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ranked = global_row_number(freq, [F.col("freq").desc(), F.col("token")], "token_id")
    return ranked.withColumn("token_id", F.col("token_id") + (first_id - 1))


def tokenized(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              max_length: int = MAX_LENGTH, unknown_id: int = UNKNOWN_ID, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """TRN1: ``(doc_id, n_tokens, input_ids array<long>, attention_mask)`` of every document.

    Row-local where the vocabulary fits a frozen dictionary of ``dictionary_bytes`` (``dictionary.freeze``): no
    token crosses a shuffle. Above it documents are dealt to chunks of about ``CHUNK_DOCS``; the distinct tokens of
    each chunk, not every occurrence, are joined to the vocabulary and meet their documents as the chunk's own dictionary. A token that
    the vocabulary lacks gets ``unknown_id``; a document without tokens has empty arrays. Both ways give the same rows.
    """
    d = freeze(vocab, dictionary_bytes)
    if d is not None:
        t = with_once(docs.select(id_col, text_col), _t=F.coalesce(tokens(F.col(text_col), max_length), F.array().cast("array<string>")))
        return t.select(id_col, F.size("_t").cast("long").alias("n_tokens"), d.ids(F.col("_t"), unknown_id).alias("input_ids"),
                        F.array_repeat(F.lit(1), F.size("_t")).alias("attention_mask"))
    chunks = -(-docs.count() // CHUNK_DOCS) or 1
    chunk = F.pmod(F.xxhash64(id_col, text_col), F.lit(chunks)).alias("chunk")
    t = docs.select(F.col(id_col).alias("id"), chunk, F.coalesce(tokens(F.col(text_col), max_length), F.array().cast("array<string>")).alias("t"))
    own = t.select(F.col("chunk").alias("part"), F.explode("t").alias("token")).distinct().join(vocab.select("token", F.col("token_id").cast("long").alias("token_id")), "token")
    kind = docs.schema[id_col].dataType.simpleString()
    # tokens hold no white space: joined by a space they travel as one string
    texts = t.select("id", "chunk", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("joined"))

    def look_up(texts: pa.Table, own: pa.Table) -> pa.Table:
        texts, own = texts.combine_chunks(), own.combine_chunks()
        ids, known = own.column("token_id").combine_chunks(), own.column("token").combine_chunks()
        n = texts.column("n").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(np.cumsum(n) // CHUNK_TOKENS)) + 1).tolist(), len(n)]
        out = []
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            some = texts.slice(first, last - first)
            full = some.filter(pc.greater(some.column("n"), 0)).column("joined")
            words = pa.chunked_array([pc.split_pattern(c, " ").flatten() for c in full.chunks], pa.string())
            found = pc.fill_null(ids.take(pc.index_in(words, known)), unknown_id)
            ends = pa.array(np.concatenate([[0], np.cumsum(n[first:last])]).astype(np.int32))
            out.append(pa.table({"id": some.column("id"), "n_tokens": some.column("n"),
                                 "input_ids": pa.ListArray.from_arrays(ends, found.combine_chunks())}))
        return pa.concat_tables(out)
    g = texts.groupBy("chunk").cogroup(own.groupBy("part")).applyInArrow(look_up, f"id {kind}, n_tokens long, input_ids array<long>")
    return g.select(F.col("id").alias(id_col), "n_tokens", "input_ids", F.array_repeat(F.lit(1), F.col("n_tokens").cast("int")).alias("attention_mask"))


def shuffled_batches(docs: DataFrame, id_col: str = "doc_id", batch_size: int = BATCH_SIZE,
                     epochs: int = EPOCHS, seed: int = 42) -> DataFrame:
    """TRN3/TRN6: ``(epoch, batch_id, doc_id, pos_in_batch)``: every epoch a new
    seeded order (md5 of seed, epoch, id); consecutive runs of ``batch_size``
    form batches, the last one may be short."""
    ids = docs.select(id_col).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    ids = ids.withColumn("_k", hash_key(seed, F.col("epoch"), F.col(id_col)))
    n = docs.count()
    r = global_row_number(ids, [F.col("epoch"), F.col("_k"), F.col(id_col)], "_rn")
    rn = F.col("_rn") - F.col("epoch") * F.lit(n)  # every epoch holds all n ids
    return r.select(F.col("epoch").cast("long").alias("epoch"),
                    F.floor((rn - 1) / batch_size).cast("long").alias("batch_id"), id_col,
                    ((rn - 1) % batch_size).cast("long").alias("pos_in_batch"))


def padded_batches(batches: DataFrame, tok: DataFrame, id_col: str = "doc_id",
                   pad_id: int = PAD_ID, ignore_padding_in_labels: bool = False) -> DataFrame:
    """TRN4/TRN5: pad ids (with ``pad_id``) and masks (with 0) to the batch's
    longest sequence; labels copy the padded ids (or -100 on padding when
    ``ignore_padding_in_labels``). Batch groups hold ``batch_size`` rows."""
    # the longest of a batch from narrow rows; ids travel once, to their batch row
    size = batches.join(tok.select(id_col, "n_tokens"), id_col)
    w = Window.partitionBy("epoch", "batch_id")
    j = size.withColumn("_max", F.max("n_tokens").over(w)).drop("n_tokens").join(tok, id_col)
    pad = (F.col("_max") - F.col("n_tokens")).cast("int")
    ids = F.concat("input_ids", F.array_repeat(F.lit(pad_id).cast("long"), pad))
    mask = F.concat("attention_mask", F.array_repeat(F.lit(0), pad))
    labels = (F.concat("input_ids", F.array_repeat(F.lit(-100).cast("long"), pad))
              if ignore_padding_in_labels else ids)
    return j.select("epoch", "batch_id", "pos_in_batch", id_col, ids.alias("input_ids"),
                    mask.alias("attention_mask"), labels.alias("labels"))


def as_text(arr) -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")
