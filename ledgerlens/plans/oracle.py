"""Oracle SQL (DuckDB dialect) for every SQL-expressible registered query.

Each entry computes, from the driver's parquet views, the same rows as the
Spark query of the same name. They are independent restatements of the
rules (text rules via ``sqltext``), not translations of Spark plans.
"""

from __future__ import annotations

from ledgerlens.operators.tables import NA_TOKENS
from ledgerlens.operators import filings as fo
from ledgerlens.plans import oracle_filings as OF
from ledgerlens.plans import sqltext as S
from ledgerlens.plans.profiles import LARGE_SAMPLE, MAX_PAGE_BYTES, PROFILED

SEED = "42"
NA_LIST = "(" + ", ".join(S.q(t) for t in NA_TOKENS) + ")"


def _value_text(col: str, kind: str) -> str:
    if kind == "double":
        return S.float_text(col)
    if kind == "ts":
        return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
    return f"CAST({col} AS VARCHAR)"


def long_sql(tables=None) -> str:
    parts = []
    for t in (tables or PROFILED):
        key, cols = PROFILED[t]
        for c, kind in cols:
            v = _value_text(c, kind)
            parts.append(f"SELECT '{t}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{c}' AS column_name, "
                         f"CASE WHEN {v} IN {NA_LIST} THEN NULL ELSE {v} END AS value FROM {t}")
    return "\nUNION ALL ".join(parts)


def sample_sql(n: int, purpose: str, tables=None) -> str:
    key = S.md5_key(S.q(SEED), S.q(purpose), "table_name", "column_name", "row_key")
    return f"""
SELECT table_name, column_name, rank, value FROM (
  SELECT table_name, column_name, value,
         row_number() OVER (PARTITION BY table_name, column_name ORDER BY {key}, row_key) AS rank
  FROM ({long_sql(tables)}) WHERE value IS NOT NULL)
WHERE rank <= {n}"""


def column_list_sql(tables=None) -> str:
    rows = ", ".join(f"('{t}', '{c}')" for t in (tables or PROFILED) for c, _ in PROFILED[t][1])
    return f"SELECT * FROM (VALUES {rows}) AS v(table_name, column_name)"


def column_documents_sql(tables=None) -> str:
    cleaned = S.strip("replace(value, chr(10), ' ')")
    return f"""
WITH s AS (SELECT table_name, column_name, rank, {cleaned} AS v FROM ({sample_sql(100, 'docs', tables)}) WHERE rank <= 50),
items AS (SELECT table_name, column_name, string_agg('- ' || v || chr(10), '' ORDER BY rank) AS body
          FROM s WHERE v <> '' GROUP BY table_name, column_name)
SELECT c.table_name, c.column_name,
       'Column: ' || c.column_name || chr(10) || 'Examples:' || chr(10) || coalesce(i.body, '') AS doc
FROM ({column_list_sql(tables)}) c LEFT JOIN items i USING (table_name, column_name)"""


def normalized_cells_sql() -> str:
    src = S.normalize_number_from(sample_sql(20, "cells"), "value", out="num")
    return f"""
SELECT table_name, column_name, rank, value, coalesce({S.float_text('num')}, value) AS cell FROM ({src})"""


def number_strings_sql() -> str:
    """Messy numeric strings rendered from lineitem (same rule as Spark)."""
    money = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
    us = "format('{:,.2f}', CAST(l_extendedprice AS DECIMAL(18,2)))"
    eu = f"translate({us}, ',.', '.,')"
    pct = "CAST(CAST(l_discount * 100 AS DECIMAL(18,2)) AS VARCHAR) || '%'"
    return f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       CASE l_returnflag WHEN 'A' THEN '$ ' || {us}
                         WHEN 'N' THEN {eu}
                         ELSE '(' || {money} || ')' END AS raw
FROM lineitem
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || 'p', {pct} FROM lineitem
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || 'q',
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) || '00' FROM lineitem"""


def normalize_numbers_sql(mode: str) -> str:
    src = S.normalize_number_from(number_strings_sql(), "raw", mode, out="n")
    return f"SELECT id, raw, round(n, 6) AS number FROM ({src})"


COMBINED_COLUMNS = ["Start Date", "End Date", "Class of Shares", "Number of Shares", "Average Price per Share",
                    "CIK", "Filing Date"]


def oracle_sql() -> dict[str, str]:
    from ledgerlens.plans import oracle_vectors as OV
    pt = OF.PAGES_TEXT
    blank = "SELECT CAST(-1 - r_regionkey AS BIGINT) AS doc_id, ' ' || chr(10) AS text FROM region"
    all_docs = f"(SELECT doc_id, text FROM documents UNION ALL {blank})"
    docs = f"SELECT doc_id AS id, text FROM {all_docs}"

    def pooled_docs(how="mean", normalize=True):
        zero = f"SELECT doc_id AS id, CAST(j AS BIGINT) AS dim, 0.0 AS value FROM ({blank}), range(0, 32) r(j)"
        return f"SELECT * FROM ({OV.pooled(docs, 'text', how, normalize=normalize)}) UNION ALL {zero}"

    def by(col, long):
        return f"SELECT id AS {col}, dim, round(value, 6) AS value FROM ({long})"

    emb = OV.embeddings_long()
    cent = ("SELECT e.id, e.dim, (e.value + c.value) / 2 AS value FROM (" + emb + ") e "
            "JOIN embeddings x ON x.vec_id = e.id JOIN (SELECT x.label, e.dim, avg(e.value) AS value FROM ("
            + emb + ") e JOIN embeddings x ON x.vec_id = e.id GROUP BY x.label, e.dim) c "
            "ON c.label = x.label AND c.dim = e.dim")
    ix = OV.column_index_src()
    col_vecs = OV.projected(OV.pooled(f"SELECT id, doc FROM ({ix})", "doc"), 32)
    dims = ", ".join(f"round(max(value) FILTER (WHERE dim = {i}), 6) AS dim_{i}" for i in range(256))
    merge = f"""
SELECT 'column' AS type, ix.table_name, ix.name, CAST(ix.id AS BIGINT) AS row_index, {dims}
FROM ({col_vecs}) v JOIN ({ix}) ix ON ix.id = v.id GROUP BY ix.table_name, ix.name, ix.id
UNION ALL
SELECT 'cell' AS type, table_name, column_name AS name, CAST(rank - 1 AS BIGINT) AS row_index, {dims}
FROM ({OV.cell_embeddings()}) GROUP BY table_name, column_name, rank"""
    toks = OV.tokens("text")
    tok = f"""
WITH d AS (SELECT doc_id, {toks} AS toks FROM {all_docs}),
t AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM d),
v AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id FROM t GROUP BY token)
SELECT d.doc_id, count(token_id) AS n_tokens, coalesce(string_agg(CAST(token_id AS VARCHAR), ',' ORDER BY pos), '') AS input_ids
FROM d LEFT JOIN (t JOIN v USING (token)) u ON u.doc_id = d.doc_id GROUP BY d.doc_id"""
    batches = f"""
SELECT CAST(epoch AS BIGINT) AS epoch, CAST((rn - 1) // 2 AS BIGINT) AS batch_id, doc_id, CAST((rn - 1) % 2 AS BIGINT) AS pos_in_batch
FROM (SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY
        md5(concat_ws('|', '42', CAST(epoch AS VARCHAR), CAST(doc_id AS VARCHAR))), doc_id) AS rn
      FROM {all_docs}, range(0, 2) r(epoch))"""
    padded = f"""
WITH t AS ({tok}), b AS ({batches}),
j AS (SELECT b.*, t.n_tokens, t.input_ids, max(t.n_tokens) OVER (PARTITION BY b.epoch, b.batch_id) AS mx
      FROM b JOIN t USING (doc_id))
SELECT epoch, batch_id, pos_in_batch, doc_id,
       ltrim(input_ids || repeat(',0', CAST(mx - n_tokens AS INTEGER)), ',') AS input_ids,
       ltrim(array_to_string(list_transform(range(n_tokens), lambda z: '1'), ',') || repeat(',0', CAST(mx - n_tokens AS INTEGER)), ',') AS attention_mask,
       ltrim(input_ids || repeat(',0', CAST(mx - n_tokens AS INTEGER)), ',') AS labels
FROM j"""
    manifest = ("SELECT 'filings/' || CAST(o_orderkey AS VARCHAR) || '.txt' AS path, "
                "lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, "
                "CASE WHEN starts_with(o_orderpriority, '1') THEN '5' ELSE '2' END AS item_number FROM orders")
    ws = S.WS
    sec = " ".join(f"WHEN m.item_number = '{it}' THEN regexp_extract(f.text, "
                   f"{S.q(rf'(?is)(Part{ws}+II.*Item{ws}+{it}.*?)(?:Item{ws}+' + chr(92) + 'd|' + chr(92) + 'n?' + chr(92) + 'z)')}, 1)"
                   for it in ("2", "5"))
    mj = (f"SELECT f.filing_id, m.path, m.cik, m.filing_date, m.item_number, CAST(length(f.text) AS BIGINT) AS n_chars, "
          f"CAST(length(CASE {sec} ELSE '' END) AS BIGINT) AS section_chars "
          f"FROM ({OF.derived_filings()}) f JOIN ({manifest}) m ON m.path = 'filings/' || f.filing_id || '.txt'")
    csv = (f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
           f"{S.float_text('c_acctbal')} AS c_acctbal, "
           f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
    names = (f"SELECT t.filing_id, t.table_no, f.cik || '_' || f.filing_date || '_item2_table' || "
             f"CAST(t.table_no AS VARCHAR) || '.csv' AS file_name "
             f"FROM ({OF.csv_ok_tables()}) t "
             f"JOIN ({OF.filing_fields()}) f USING (filing_id)")
    return {
        "filing_manifest_join": mj,
        "csv_all_string": csv,
        "v1_table_names": names,
        "tokenized_docs": tok,
        "shuffled_batches": batches,
        "padded_batches": padded,
        "dataset_items": f"SELECT idx, length, doc_id, n_tokens, input_ids FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx, "
                         f"count(*) OVER () AS length FROM ({tok})) WHERE idx % 100 = 0",
        "extraction_run": OF.extraction_run(COMBINED_COLUMNS),
        "embed_documents": by("doc_id", pooled_docs()),
        "pool_mean": by("doc_id", pooled_docs("mean", False)),
        "pool_first": by("doc_id", pooled_docs("first", False)),
        "pool_max": by("doc_id", pooled_docs("max", False)),
        "l2_normalize": by("vec_id", OV.normalized(emb)),
        "project_vectors": by("vec_id", OV.projected(emb, 64, 256)),
        "ensemble_vectors": by("vec_id", OV.normalized(cent)),
        "topk_search": f"SELECT query_id, id, round(score, 6) AS score, rank FROM ({OV.topk(emb, emb, 5, 0.5)})",
        "topk_search_pruned": f"SELECT query_id, id, round(score, 6) AS score, rank FROM ({OV.topk(emb, emb, 5, 0.0)})",
        "topk_search_blocked": f"SELECT query_id, id, round(score, 6) AS score, rank FROM ({OV.topk(emb, emb, 5, 0.0)})",
        "merge_embeddings": merge,
        "merged_from_files": OV.merged_from_files(64),
        "saved_status": OV.saved_status(),
        "cell_prompts": OV.cell_prompts(),
        "cell_embeddings": OV.cell_embeddings(),
        "html_to_text": pt,
        "filing_lines": OF.filing_lines_sql(pt),
        "filing_fields": OF.filing_fields(),
        "item_section": OF.item_section(),
        "line_header_lev": f"SELECT filing_id, pos, line, round({OF.lev_ratio('line')}, 6) AS score "
                           f"FROM ({OF.filing_lines_sql(pt)})",
        "line_header_score": OF.line_header_score(pt),
        "best_chunk": OF.best_chunk(pt),
        "best_chunk_lev": OF.best_chunk_lev(pt),
        "canonical_columns": OF.canonical_columns(),
        "canonical_cells": OF.canonical_cells(),
        "filing_scan": OF.filing_scan(),
        "filing_stream": OF.filing_stream(),
        "parsed_files": OF.parsed_files(),
        "v1_files": OF.v1_files(),
        "filing_outcomes": OF.filing_outcomes(MAX_PAGE_BYTES),
        "extraction_prompts": f"SELECT filing_id, {S.q(fo.PROMPT_V2_HEAD)} || chunk || {S.q(fo.PROMPT_V2_TAIL)} AS prompt "
                              f"FROM ({OF.best_chunk_lev(pt)}) WHERE chunk IS NOT NULL",
        "extraction_prompts_v1": f"SELECT filing_id, {S.q(fo.PROMPT_V1_HEAD)} || substr(section, 1, {fo.V1_TEXT_BUDGET}) || "
                                 f"{S.q(fo.PROMPT_V1_TAIL)} AS prompt FROM ({OF.item_section()}) WHERE section <> ''",
        "truncate_tokens": f"SELECT doc_id, {OF.truncate_tokens('text', 1024)} AS text FROM documents",
        "shorten_text": f"SELECT doc_id, {OF.shorten('text')} AS text FROM documents",
        "answer_extract": OF.answers_sql(),
        "pipe_table_cells": OF.pipe_table_cells(),
        "extraction_status": OF.extraction_status(),
        "combine_tables": OF.combine_tables(COMBINED_COLUMNS),
        "csv_tables_cells": OF.csv_tables(),
        "tables_with_provenance": OF.tables_with_provenance(),
        "csv_edge_cells": OF.csv_edge_cells(),
        "html_table_cells": OF.html_table_cells(),
        "csv_edge_status": OF.csv_edge_status(),
        "decode_references": OF.DECODE_REFERENCES,
        "unpivot_columns": f"SELECT * FROM ({long_sql(['part'])})",
        "sample_per_column": sample_sql(100, "docs"),
        "sample_large": sample_sql(LARGE_SAMPLE, "large"),
        "column_documents": column_documents_sql(),
        "normalized_cells": normalized_cells_sql(),
        "normalize_numbers": normalize_numbers_sql("reference"),
        "normalize_numbers_accounting": normalize_numbers_sql("accounting"),
    }
