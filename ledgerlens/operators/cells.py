"""Retrieval-augmented cell embeddings (VEC13, VEC14) and the column index.

One DataFrame plan for all columns of all tables:

    column documents -> embed -> project                   = column index
    cells (second sample, numbers normalised) -> embed -> project
        -> top-k against the column index -> prompt -> embed -> project

With a costly encoder (a model) cells and prompts with identical text are
embedded once (``distinct`` before the encoder, joined back). The column index has one row per column, so its
size is bounded by the schema and the search uses the broadcast strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import shorten
from ledgerlens.operators import retrieval as rt
from ledgerlens.operators import vectors as vx
from ledgerlens.operators.trainprep import global_row_number
from ledgerlens.session import ensure_checkpoint_dir

# --- fixed values: prompt wording of the cell encoder -----------------------
TARGET_PREFIX = "Target column: "
RELATED_HEADER = "Related columns and examples:\n"
CELL_PREFIX = "Cell to encode: "
CELL_SUFFIX = "\n\nEncode the cell relative to the target column and the related columns."
RELATED_DOC_WIDTH = 800
PIPELINE_K = 3
# --------------------------------------------------------------------------


def column_index(docs: DataFrame, encoder=None, weights: DataFrame | None = None,
                 materialize: bool = True) -> DataFrame:
    """``(id, table_name, name, doc, vec)`` - ids by (table, column) order, numbered
    over range partitions (``global_row_number``), so any number of columns will do.

    The index is read several times (size check, broadcast, metadata,
    target documents); it is checkpointed once to the cluster's checkpoint
    folder so the sampling behind it is not recomputed for every read.
    """
    d = global_row_number(docs, [F.col("table_name"), F.col("column_name")], "id").withColumn("id", F.col("id") - 1)
    d = vx.embed(d, "doc", encoder, out="vec")
    if weights is not None:
        d = vx.project(d, "vec", weights, out="vec")
    out = d.select("id", "table_name", F.col("column_name").alias("name"), "doc", "vec")
    if materialize:
        ensure_checkpoint_dir(out.sparkSession)
        out = out.checkpoint()
    return out


def _embed_rows(df: DataFrame, text_col: str, encoder, weights, dedupe: bool | None) -> DataFrame:
    """Add ``vec`` (embedding of ``text_col``, projected when weights are
    given). With ``dedupe`` each distinct text is embedded once and joined
    back - worth its shuffle only for costly encoders (a model), so by
    default only ``ModelEncoder`` dedupes."""
    enc = encoder or vx.HashTokenEncoder()
    if dedupe is None:
        dedupe = isinstance(enc, vx.ModelEncoder)
    if not dedupe:
        d = vx.embed(df, text_col, enc, out="vec")
        return vx.project(d, "vec", weights, out="vec") if weights is not None else d
    u = vx.embed(df.select(text_col).distinct(), text_col, enc, out="vec")
    if weights is not None:
        u = vx.project(u, "vec", weights, out="vec")
    return df.join(u, text_col)


def cell_prompts(cells: DataFrame, index: DataFrame, encoder=None, weights: DataFrame | None = None,
                 k: int = PIPELINE_K, floor: float = rt.DEFAULT_FLOOR, dedupe: bool | None = None) -> DataFrame:
    """VEC13: prompt per cell: target column document, up to ``k`` related
    columns (name + document shortened to 800 characters) retrieved with the
    cell's own embedding, then the cell.

    ``cells``: ``(table_name, column_name, rank, cell)``;
    ``index``: from ``column_index``. Returns cells + ``prompt``.
    """
    c = cells.withColumn("cell_id", F.xxhash64("table_name", "column_name", "rank"))
    q = _embed_rows(c, "cell", encoder, weights, dedupe)  # cells: a bounded sample (n per column)
    hits = rt.topk_search(q, index, k=k, floor=floor, query_id="cell_id", query_vec="vec")
    hits = rt.with_metadata(hits, index)
    related = (hits.groupBy("query_id")
               .agg(F.array_sort(F.collect_list(F.struct("rank", "name", "doc"))).alias("hits")))
    block = F.concat(F.lit(RELATED_HEADER), F.array_join(F.transform("hits", lambda h: F.concat(
        F.lit("Column: "), h["name"], F.lit("\n"), shorten(h["doc"], RELATED_DOC_WIDTH), F.lit("\n\n"))), ""))
    target = index.select("table_name", F.col("name").alias("column_name"), F.col("doc").alias("target_doc"))
    out = (c.join(related, c.cell_id == related.query_id, "left")
           .join(target, ["table_name", "column_name"]))
    prompt = F.concat(F.lit(TARGET_PREFIX), F.col("column_name"), F.lit("\n"), F.col("target_doc"), F.lit("\n\n"),
                      F.when(F.size(F.coalesce("hits", F.array())) > 0, block).otherwise(F.lit("")),
                      F.lit(CELL_PREFIX), F.col("cell"), F.lit(CELL_SUFFIX))
    return out.select("table_name", "column_name", "rank", "cell", prompt.alias("prompt"))


def cell_embeddings(prompts: DataFrame, encoder=None, weights: DataFrame | None = None,
                    dedupe: bool | None = None) -> DataFrame:
    """VEC14: embedding of every cell prompt (second encoder pass)."""
    v = _embed_rows(prompts, "prompt", encoder, weights, dedupe)
    return v.select("table_name", "column_name", "rank", "cell", "vec")
