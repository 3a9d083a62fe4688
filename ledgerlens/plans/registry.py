"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables whole (or data Spark derives from
them); none caps, samples or filters rows to stay cheap. Column names equal
those of the oracle SQL of the same name (``ledgerlens.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import columns as colops
from ledgerlens.operators import extraction as ex
from ledgerlens.operators import filings as fo
from ledgerlens.operators import models
from ledgerlens.operators import tables as tb
from ledgerlens.operators import vectors as vx
from ledgerlens.operators import retrieval as rt
from ledgerlens.operators import cells as ce
from ledgerlens.operators import trainprep as tp
from ledgerlens.operators import htmltables as ht
from ledgerlens.sources import csvio, dataset, rowfiles, saved
from ledgerlens.sources import widecsv as wide
from ledgerlens.session import scratch_dir
from ledgerlens.sources import filings as src
from ledgerlens.plans import extraction_run
from ledgerlens.plans.profiles import LARGE_SAMPLE, MAX_PAGE_BYTES, profiled_columns, profiled_long
from ledgerlens.sources.tables import table
from ledgerlens.functions.text import decode_entities
from ledgerlens.functions.vectors import round_half

Query = Callable[[SparkSession, str], DataFrame]


def q_unpivot_columns(spark, sf_dir):
    return profiled_long(spark, sf_dir, ["part"])


def q_sample_per_column(spark, sf_dir):
    return colops.sample_per_column(profiled_long(spark, sf_dir), n=colops.SAMPLE_PER_COLUMN)


def q_sample_large(spark, sf_dir):
    """COL2 with more values a column than the planner limits before a shuffle."""
    return colops.sample_per_column(profiled_long(spark, sf_dir), n=LARGE_SAMPLE, purpose="large")


def q_column_documents(spark, sf_dir):
    return colops.column_documents(spark, profiled_long(spark, sf_dir), profiled_columns())


def q_normalized_cells(spark, sf_dir):
    return colops.normalized_cells(profiled_long(spark, sf_dir))


def number_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy numeric strings rendered from lineitem: US and EU grouping with
    currency, accounting parentheses, percents, bare thousands grouping."""
    li = table(spark, sf_dir, "lineitem")
    rid = F.concat(li.l_orderkey.cast("string"), F.lit("-"), li.l_linenumber.cast("string"))
    money = li.l_extendedprice.cast("decimal(18,2)")
    us = F.format_number(money, 2)
    eu = F.translate(us, ",.", ".,")
    raw = (F.when(li.l_returnflag == "A", F.concat(F.lit("$ "), us))
           .when(li.l_returnflag == "N", eu)
           .otherwise(F.concat(F.lit("("), money.cast("string"), F.lit(")"))))
    pct = F.concat((li.l_discount * 100).cast("decimal(18,2)").cast("string"), F.lit("%"))
    grouped = F.concat(li.l_quantity.cast("long").cast("string"), F.lit(","),
                       li.l_linenumber.cast("string"), F.lit("00"))
    return li.select(F.inline(F.array(
        F.struct(rid.alias("id"), raw.alias("raw")),
        F.struct(F.concat(rid, F.lit("p")).alias("id"), pct.alias("raw")),
        F.struct(F.concat(rid, F.lit("q")).alias("id"), grouped.alias("raw")))))


def _numbers(mode):
    def run(spark, sf_dir):
        df = colops.normalize_numbers(number_strings(spark, sf_dir), "raw", mode)
        return df.select("id", "raw", round_half("number", 6).alias("number"))
    return run


# ------------------------------------------------------------ filings ------

def pages_text(spark, sf_dir):
    return fo.html_to_text(src.pages_as_filings(spark, sf_dir)).select("filing_id", "text")


def q_html_to_text(spark, sf_dir):
    return pages_text(spark, sf_dir)


def q_filing_lines(spark, sf_dir):
    return fo.filing_lines(pages_text(spark, sf_dir))


def q_filing_fields(spark, sf_dir):
    return fo.filing_fields(src.derived_filings(spark, sf_dir))


def q_item_section(spark, sf_dir):
    return fo.item_section(src.derived_filings(spark, sf_dir))


def q_line_header_score(spark, sf_dir):
    return fo.line_header_score(fo.filing_lines(pages_text(spark, sf_dir)))


def q_line_header_lev(spark, sf_dir):
    out = fo.line_header_lev(fo.filing_lines(pages_text(spark, sf_dir)))
    return out.withColumn("score", round_half("score", 6))


def q_best_chunk(spark, sf_dir):
    return fo.best_chunk(pages_text(spark, sf_dir)).withColumn("best_score", round_half("best_score", 6))


def q_best_chunk_lev(spark, sf_dir):
    out = fo.best_chunk_lev(pages_text(spark, sf_dir))
    return out.withColumn("best_pos", F.col("best_pos").cast("long")).withColumn("best_score", round_half("best_score", 6))


def q_extraction_prompts(spark, sf_dir):
    ch = fo.best_chunk_lev(pages_text(spark, sf_dir))
    return ch.where(F.col("chunk").isNotNull()).select("filing_id", fo.prompt_v2("chunk").alias("prompt"))


def q_extraction_prompts_v1(spark, sf_dir):
    sec = fo.item_section(src.derived_filings(spark, sf_dir))
    return sec.where(F.col("section") != "").select("filing_id", fo.prompt_v1("section").alias("prompt"))


def q_truncate_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", fo.truncate_tokens(F.col("text"), 1024).alias("text"))


def q_shorten_text(spark, sf_dir):
    from ledgerlens.functions.text import shorten
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", shorten(F.col("text")).alias("text"))


def answers(spark, sf_dir):
    return tb.answers_from_responses(src.derived_responses(spark, sf_dir))


def q_answer_extract(spark, sf_dir):
    return answers(spark, sf_dir)


def q_pipe_table_cells(spark, sf_dir):
    return tb.pipe_table_cells(answers(spark, sf_dir))


def q_extraction_status(spark, sf_dir):
    return tb.extraction_status(answers(spark, sf_dir))


# "Dollar Value of Shares Repurchased" is not listed: its cells have to come in ``other``
COMBINED_COLUMNS = ["Start Date", "End Date", "Class of Shares", "Number of Shares", "Average Price per Share",
                    "CIK", "Filing Date"]


def answers_with_fields(spark, sf_dir):
    """Answers beside the filer and date of the filing that they are for: row-local, the run keeps both in a row."""
    e = src.derived_extractions(spark, sf_dir)
    f = fo.fields_struct("text")
    return e.select("filing_id", fo.answer_text("response").alias("answer"), f.alias("_f")).select(
        "filing_id", "answer", F.col("_f.cik").alias("cik"), F.col("_f.date").alias("filing_date"))


def q_tables_with_provenance(spark, sf_dir):
    return tb.pipe_table_cells(answers_with_fields(spark, sf_dir), provenance=("cik", "filing_date"))


def parsed_with_provenance(spark, sf_dir):
    p = tb.parse_pipe_answers(answers_with_fields(spark, sf_dir), keep=("cik", "filing_date")).where(F.col("status") == tb.STATUS_OK)
    return tb.provenance_rows(p, ("cik", "filing_date"))


def q_combine_tables(spark, sf_dir):
    tables = parsed_with_provenance(spark, sf_dir).withColumn("table_no", F.lit(1))
    return tb.combine_rows(tables, COMBINED_COLUMNS).withColumn("other", F.to_json("other"))


def q_csv_edge_cells(spark, sf_dir):
    """Cells of CSV text with empty leading fields, short rows, quoted line breaks and very long fields."""
    return tb.csv_table_cells(src.derived_csv_edges(spark, sf_dir))


def q_csv_edge_status(spark, sf_dir):
    return tb.csv_table_status(src.derived_csv_edges(spark, sf_dir))


def q_decode_references(spark, sf_dir):
    """Character references of every kind around each customer's name."""
    c = table(spark, sf_dir, "customer")
    text = F.concat(F.lit("&#38;lt;b&#38;gt; &eacute;&nbsp x&copy "), F.col("c_name"),
                    F.lit(" &#151 y &#x1F600; &notit; &AMP &am & &frac12; &#0;&#9999999999; &unknown; &amp;amp; &hearts;"))
    return c.select("c_custkey", decode_entities(text).alias("text"))


def q_csv_tables_cells(spark, sf_dir):
    return tb.csv_table_cells(src.derived_csv_answers(spark, sf_dir))


# ------------------------------------------------------------ vectors ------

ENC_DIM = 32
PROJ_DIM = 256


def documents(spark, sf_dir):
    """All documents, and a blank one for each region (ids below zero)."""
    blank = table(spark, sf_dir, "region").select((-1 - F.col("r_regionkey")).cast("long").alias("doc_id"), F.lit(" \n").alias("text"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(blank)


def q_embed_documents(spark, sf_dir):
    d = vx.embed(documents(spark, sf_dir), "text", vx.HashTokenEncoder(ENC_DIM))
    return vx.vectors_long(d, ["doc_id"])


def q_embed_model(spark, sf_dir):
    """Documents through a model with attention masks, in batches by length."""
    enc = models.MaskedEncoder(models.SeededEncoder)
    d = vx.embed(documents(spark, sf_dir), "text", enc)
    return vx.vectors_long(d, ["doc_id"], digits=5)


def _pool(how):
    def run(spark, sf_dir):
        d = vx.pool(documents(spark, sf_dir), "text", how, ENC_DIM)
        return vx.vectors_long(d, ["doc_id"])
    return run


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def q_l2_normalize(spark, sf_dir):
    return vx.vectors_long(vx.normalize(embeddings(spark, sf_dir), "vec"), ["vec_id"])


def q_project_vectors(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    w = vx.projection_weights(spark, 64, PROJ_DIM)
    return vx.vectors_long(vx.project(e, "vec", w), ["vec_id"])


def q_ensemble_vectors(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    cent = vx.group_centroids(e, "label", "vec")
    by_label = e.select("vec_id", "label").join(cent, "label").select("vec_id", "vec")
    ens = vx.ensemble([e.select("vec_id", "vec"), by_label], "vec_id")
    return vx.vectors_long(ens, ["vec_id"])


def _search(strategy, k, floor, **kw):
    def run(spark, sf_dir):
        e = embeddings(spark, sf_dir)
        hits = rt.topk_search(e, e, k=k, floor=floor, query_id="vec_id", index_id="vec_id",
                              strategy=strategy, **kw)
        return hits.withColumn("score", round_half("score", 6))
    return run


def column_docs(spark, sf_dir):
    return colops.column_documents(spark, profiled_long(spark, sf_dir), profiled_columns())


def cells(spark, sf_dir):
    return colops.normalized_cells(profiled_long(spark, sf_dir))


def q_merge_embeddings(spark, sf_dir):
    """The whole second plan: column index, cells, prompts and their projected embeddings, merged."""
    p, idx, enc, w = _cell_prompts(spark, sf_dir)
    cols = idx.select("table_name", "name", "vec", F.col("id").alias("rank"))
    cv = ce.cell_embeddings(p, enc, w).select("table_name", F.col("column_name").alias("name"), "vec", "rank")
    m = vx.merge_embeddings(cols, cv, PROJ_DIM)
    return m.select("type", "table_name", "name", "row_index",
                    *[round_half(f"dim_{i}", 6).alias(f"dim_{i}") for i in range(PROJ_DIM)])


def saved_run(spark, sf_dir):
    """The folder of a run over the embeddings: a column for each label and remainder of the id, under names with / and =,
    half of them with shorter vectors; some columns without a vector of their own, some without cells."""
    from pyspark.sql import Window
    path = _scratch(spark, "saved-run")
    e = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), (F.col("label") * 5 + F.col("vec_id") % 5).cast("long").alias("id"),
        F.concat(F.lit("year/"), (2000 + F.col("label")).cast("string")).alias("table_name"),
        F.concat(F.lit("k="), (F.col("vec_id") % 5).cast("string")).alias("name"),
        F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 16)).cast("array<double>").alias("vec"))
    own = F.min_by(F.when(F.col("id") % 7 != 3, F.col("vec")), "vec_id")
    saved.save_index(e.groupBy("id", "table_name", "name").agg(own.alias("vec")).withColumn("doc", F.concat(F.lit("Column: "), "name")), path)
    place = Window.partitionBy("id").orderBy("vec_id")
    saved.save_cells(e.where(F.col("id") % 11 != 5).withColumn("row_index", (F.row_number().over(place) - 1).cast("long")), path)
    return path


SAVED_WIDTH = 64


def q_merged_from_files(spark, sf_dir):
    m = saved.merged(spark, saved_run(spark, sf_dir))
    return m.select("type", "table_name", "name", "row_index", *[round_half(f"dim_{i}", 6).alias(f"dim_{i}") for i in range(SAVED_WIDTH)])


def q_saved_status(spark, sf_dir):
    return saved.status(spark, saved_run(spark, sf_dir))


def _cell_prompts(spark, sf_dir):
    enc = vx.HashTokenEncoder(ENC_DIM)
    w = vx.projection_weights(spark, ENC_DIM, PROJ_DIM)
    idx = ce.column_index(column_docs(spark, sf_dir), enc, w)
    return ce.cell_prompts(cells(spark, sf_dir).select("table_name", "column_name", "rank", "cell"), idx, enc, w), idx, enc, w


def q_cell_prompts(spark, sf_dir):
    return _cell_prompts(spark, sf_dir)[0]


def q_cell_embeddings(spark, sf_dir):
    p, _, enc, w = _cell_prompts(spark, sf_dir)
    return vx.vectors_long(ce.cell_embeddings(p, enc, w), ["table_name", "column_name", "rank"])


# ------------------------------------------------------- training data ----

TRAIN_EPOCHS = 2


def q_tokenized_docs(spark, sf_dir):
    d = documents(spark, sf_dir)
    t = tp.tokenized(d, tp.vocabulary(d))
    return t.select("doc_id", "n_tokens", tp.as_text("input_ids").alias("input_ids"))


def q_shuffled_batches(spark, sf_dir):
    return tp.shuffled_batches(documents(spark, sf_dir), epochs=TRAIN_EPOCHS)


def q_padded_batches(spark, sf_dir):
    d = documents(spark, sf_dir)
    t = tp.tokenized(d, tp.vocabulary(d))
    p = tp.padded_batches(tp.shuffled_batches(d, epochs=TRAIN_EPOCHS), t)
    return p.select("epoch", "batch_id", "pos_in_batch", "doc_id", tp.as_text("input_ids").alias("input_ids"),
                    tp.as_text("attention_mask").alias("attention_mask"), tp.as_text("labels").alias("labels"))


def q_dataset_items(spark, sf_dir):
    """Tokenised documents written with a manifest; every hundredth item read back through it, beside the length."""
    d = documents(spark, sf_dir)
    t = tp.tokenized(d, tp.vocabulary(d))
    path = _scratch(spark, "dataset")
    dataset.write_dataset(t, path, [F.col("doc_id")], file_rows=DATASET_FILE_ROWS)
    ds = dataset.IndexedDataset(spark, path)
    n = len(ds)
    return ds.items(range(0, n, 100)).select("idx", F.lit(n).cast("long").alias("length"), "doc_id", "n_tokens", tp.as_text("input_ids").alias("input_ids"))


DATASET_FILE_ROWS = 250


# ------------------------------------------------- sources, sinks, HTML ----

def q_filing_manifest_join(spark, sf_dir):
    f = src.derived_filings(spark, sf_dir).withColumn(
        "path", F.concat(F.lit("filings/"), F.col("filing_id"), F.lit(".txt")))
    j = src.join_manifest(f, src.derived_manifest(spark, sf_dir), "path")
    j = fo.item_section(j, item_col="item_number")
    return j.select("filing_id", "path", "cik", "filing_date", "item_number",
                    F.length("text").cast("long").alias("n_chars"),
                    F.length("section").cast("long").alias("section_chars"))


def csv_source_frame(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(c.c_custkey.cast("string").alias("c_custkey"), "c_name",
                    c.c_nationkey.cast("string").alias("c_nationkey"),
                    colops.value_text(c.c_acctbal, c.schema["c_acctbal"].dataType).alias("c_acctbal"),
                    F.when(c.c_mktsegment == "HOUSEHOLD", F.lit("NA")).otherwise(c.c_mktsegment).alias("c_mktsegment"))


def q_csv_all_string(spark, sf_dir):
    import uuid
    path = scratch_dir(spark, f"csv-customer-{uuid.uuid4().hex}")
    csvio.write_csv(csv_source_frame(spark, sf_dir), path)
    return csvio.read_csv_all_strings(spark, path)


def q_v1_table_names(spark, sf_dir):
    st = tb.csv_table_status(src.derived_csv_answers(spark, sf_dir)).where(F.col("status") == "ok")
    fields = fo.filing_fields(src.derived_filings(spark, sf_dir))
    return tb.v1_table_names(st.join(fields, "filing_id"))


def _filing_files(spark, sf_dir, with_bad: bool = False):
    """Write the pages as one text file per page under the scratch area; ``with_bad`` spoils some with bytes that are no UTF-8."""
    import uuid
    path = scratch_dir(spark, f"filing-files-{uuid.uuid4().hex}")
    html = F.coalesce("html", F.lit("")).cast("binary")
    if with_bad:
        html = F.when(F.col("filing_id").cast("long") % 50 == 7, F.concat(html, F.unhex(F.lit("FFFE")))).otherwise(html)
    name = F.concat(F.lit("filing_id="), F.coalesce("filing_id", F.lit("__HIVE_DEFAULT_PARTITION__")))
    # the line break that ends a text file
    rowfiles.write_rows(src.pages_as_filings(spark, sf_dir).select(name.alias("name"), F.concat(html, F.lit(b"\n")).alias("content")), path)
    return path


#: Name of a page's file, after its id.
PAGE_FILE = r"filing_id=([^/]+)-[0-9]+\.txt$"


def _page_id():
    """Id of the page that a file written by ``_filing_files`` holds."""
    return F.regexp_extract("path", PAGE_FILE, 1)


def q_filing_scan(spark, sf_dir):
    path = _filing_files(spark, sf_dir)
    s = src.scan_filing_folder(spark, path, recursive=True)
    t = fo.html_to_text(s.withColumn("filing_id", _page_id()))
    return t.select("filing_id", F.length("html").cast("long").alias("n_chars"),
                    F.size(F.split("text", "\n")).cast("long").alias("n_nodes"))


def q_filing_stream(spark, sf_dir):
    """Every page as a file, taken in by the stream in several micro-batches; unreadable ones come as dead letters."""
    import uuid
    from ledgerlens.streaming import filings as sf
    path = _filing_files(spark, sf_dir, with_bad=True)
    run = uuid.uuid4().hex
    sink, ck = scratch_dir(spark, f"stream-out-{run}"), scratch_dir(spark, f"stream-ck-{run}")
    sf.start_extraction(spark, path, sink, ck).awaitTermination()
    return sf.outcomes(spark, sink).select(
        _page_id().alias("filing_id"), "outcome", "status", "reason", "cik", "filing_date", "n_lines", "best_pos",
        round_half("best_score", 6).alias("best_score"), "prompt")


def page_files(spark, sf_dir):
    """The pages as the binary file source gives files, a few of them spoiled or blank."""
    n = F.col("page_id") % 50
    html = F.coalesce("html", F.lit("")).cast("binary")
    content = F.when(n == 7, F.concat(html, F.unhex(F.lit("FFFE")))).when(n == 11, F.lit(b" \n")).otherwise(html)
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("filing_id"), F.lit("pages").alias("path"),
                                                F.length(content).cast("long").alias("length"), content.alias("content"))


def page_responses(spark, sf_dir):
    """The rendered answers, of which some are reports of a failed model call."""
    failed = F.when(F.col("filing_id").cast("long") % 40 == 3, F.lit("timeout"))
    return src.derived_responses(spark, sf_dir).withColumn("error", failed)


def q_filing_outcomes(spark, sf_dir):
    prompts = ex.filing_prompts(ex.readable(page_files(spark, sf_dir), max_bytes=MAX_PAGE_BYTES))
    out = ex.filing_outcomes(prompts, page_responses(spark, sf_dir))
    return out.select("filing_id", "status", "reason", "cik", "filing_date", F.array_join("header", "|").alias("header"),
                      F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n").alias("rows"))


def _scratch(spark, name):
    import uuid
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


def q_extraction_run(spark, sf_dir):
    """The whole run over the pages as files, with the rendered answers for the model: its combined table, read again."""
    folder, out = _filing_files(spark, sf_dir, with_bad=True), _scratch(spark, "extraction-run")
    page = F.regexp_extract("filing_id", PAGE_FILE, 1)

    def ask(prompts):
        answers = page_responses(spark, sf_dir).withColumnRenamed("filing_id", "page")
        return prompts.select("filing_id", page.alias("page")).join(answers, "page").select("filing_id", "response", "error")
    extraction_run.run(spark, folder, out, ask, columns=COMBINED_COLUMNS)
    back = csvio.read_csv_all_strings(spark, f"{out}/combined", na_tokens=[""])
    return back.select(page.alias("filing_id"), F.col("row_no").cast("long").alias("row_no"), *COMBINED_COLUMNS, "other")


def q_parsed_files(spark, sf_dir):
    """SNK1 there and back: a CSV file with its own header for each filing with a table, read again as cells."""
    path = _scratch(spark, "parsed-files")
    wide.write_parsed(parsed_with_provenance(spark, sf_dir), path)
    return wide.read_tables(spark, path)


def q_v1_files(spark, sf_dir):
    """SNK3 there and back: a CSV file for each table of each answer, named by filer, date, item and number."""
    path = _scratch(spark, "v1-files")
    fields = fo.filing_fields(src.derived_filings(spark, sf_dir))
    wide.write_tables(wide.csv_tables(src.derived_csv_answers(spark, sf_dir), fields), path)
    return wide.read_tables(spark, path)


def q_html_table_cells(spark, sf_dir):
    return ht.html_table_cells(src.derived_html_filings(spark, sf_dir))


def q_canonical_columns(spark, sf_dir):
    return ht.canonical_columns(ht.html_table_cells(src.derived_html_filings(spark, sf_dir)))


def q_canonical_cells(spark, sf_dir):
    return ht.canonical_cells(src.derived_html_filings(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "filing_manifest_join": q_filing_manifest_join,
        "csv_all_string": q_csv_all_string,
        "v1_table_names": q_v1_table_names,
        "filing_scan": q_filing_scan,
        "filing_stream": q_filing_stream,
        "filing_outcomes": q_filing_outcomes,
        "parsed_files": q_parsed_files,
        "v1_files": q_v1_files,
        "html_table_cells": q_html_table_cells,
        "canonical_columns": q_canonical_columns,
        "canonical_cells": q_canonical_cells,
        "tokenized_docs": q_tokenized_docs,
        "shuffled_batches": q_shuffled_batches,
        "padded_batches": q_padded_batches,
        "dataset_items": q_dataset_items,
        "extraction_run": q_extraction_run,
        "embed_documents": q_embed_documents,
        "embed_model": q_embed_model,
        "pool_mean": _pool("mean"),
        "pool_first": _pool("first"),
        "pool_max": _pool("max"),
        "l2_normalize": q_l2_normalize,
        "project_vectors": q_project_vectors,
        "ensemble_vectors": q_ensemble_vectors,
        "topk_search": _search("auto", rt.DEFAULT_K, rt.DEFAULT_FLOOR),
        "topk_search_blocked": _search("blocked", rt.DEFAULT_K, 0.0, query_block=128, index_block=128),
        "topk_search_pruned": _search("pruned", rt.DEFAULT_K, 0.0, query_block=128, index_block=32),
        "merge_embeddings": q_merge_embeddings,
        "merged_from_files": q_merged_from_files,
        "saved_status": q_saved_status,
        "cell_prompts": q_cell_prompts,
        "cell_embeddings": q_cell_embeddings,
        "html_to_text": q_html_to_text,
        "filing_lines": q_filing_lines,
        "filing_fields": q_filing_fields,
        "item_section": q_item_section,
        "line_header_score": q_line_header_score,
        "line_header_lev": q_line_header_lev,
        "best_chunk": q_best_chunk,
        "best_chunk_lev": q_best_chunk_lev,
        "extraction_prompts": q_extraction_prompts,
        "extraction_prompts_v1": q_extraction_prompts_v1,
        "truncate_tokens": q_truncate_tokens,
        "shorten_text": q_shorten_text,
        "answer_extract": q_answer_extract,
        "pipe_table_cells": q_pipe_table_cells,
        "extraction_status": q_extraction_status,
        "combine_tables": q_combine_tables,
        "tables_with_provenance": q_tables_with_provenance,
        "csv_edge_cells": q_csv_edge_cells,
        "csv_edge_status": q_csv_edge_status,
        "decode_references": q_decode_references,
        "csv_tables_cells": q_csv_tables_cells,
        "unpivot_columns": q_unpivot_columns,
        "sample_per_column": q_sample_per_column,
        "sample_large": q_sample_large,
        "column_documents": q_column_documents,
        "normalized_cells": q_normalized_cells,
        "normalize_numbers": _numbers("reference"),
        "normalize_numbers_accounting": _numbers("accounting"),
    }
