"""Table extraction from answer text (TAB1-TAB7).

Tables have dynamic columns (taken from each answer's header line), so the
canonical result is long: ``(filing_id, table_no, row_no, col_no, col_name,
value)``. Wide frames are produced only at the edge (``combine_tables``) by
one pivot with an explicit column list - never one plan per filing.

Parsing is row-local (array functions on each answer); the only shuffle is
the final pivot.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import text as tx
from ledgerlens.operators.filings import (ANSWER_MARKER, CANONICAL_COLUMNS, END_MARKER,
                                          PROVENANCE_COLUMNS, answer_text)

# --- fixed values: pandas' default missing-value tokens (read as null) -------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]
TABLE_SEPARATOR = "---TABLE---"
FILLER = "N/A"
# --------------------------------------------------------------------------

STATUS_OK = "ok"


def _dedupe_names(names: Column, sep: str = "_", first_suffix: int = 2) -> Column:
    """Make header names unique: the k-th repeat of a name gets ``{sep}{k+first_suffix-1}``."""
    return F.transform(names, lambda n, i: F.when(
        F.size(F.filter(F.slice(names, 1, i), lambda m: m == n)) > 0,
        F.concat(n, F.lit(sep), (F.size(F.filter(F.slice(names, 1, i), lambda m: m == n))
                                 + F.lit(first_suffix - 1)).cast("string"))).otherwise(n))


def pipe_fields(line: Column, outer_pipes: str = "always") -> Column:
    """Fields of a table line, stripped.

    ``always``: what stands outside the first and the last pipe is not a field.
    ``auto``: it is one unless it is blank, so lines without outer pipes are read too.
    """
    parts = F.transform(F.split(line, r"\|", -1), tx.py_strip)
    inner = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    if outer_pipes == "always":
        return inner
    first, last = F.slice(parts, 1, 1), F.slice(parts, -1, 1)
    drop_blank = lambda a: F.filter(a, lambda x: x != F.lit(""))
    return F.when(F.size(parts) > 1, F.concat(drop_blank(first), inner, drop_blank(last))).otherwise(inner)


def parse_pipe_answers(df: DataFrame, answer_col: str = "answer",
                       cut_at_end_marker: bool = True,
                       dedupe_headers: bool = True, outer_pipes: str = "always",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Per answer: ``(filing_id, header array, rows array<array>, status)``.

    Lines with ``|`` and without ``---`` are table lines; the first is the
    header. Short rows are padded with ``N/A``; a row longer than the header
    fails the whole answer (``parse_failed``). ``no_table``: no table line;
    ``header_only``: no data line; ``empty_answer``: blank answer.
    """
    a = F.col(answer_col)
    if cut_at_end_marker:
        i = F.instr(a, END_MARKER)
        a = F.when(i > 0, F.substring(a, F.lit(1), i - 1)).otherwise(a)
    lines = F.filter(F.split(a, "\n", -1), lambda l: l.contains("|") & ~l.contains("---"))
    d = tx.with_once(df.select("filing_id", answer_col, *[F.col(f"`{c}`") for c in keep]), _lines=lines)
    d = tx.with_once(d, _fields=F.transform("_lines", lambda l: pipe_fields(l, outer_pipes)))
    d = tx.with_once(d, _header=F.coalesce(F.try_element_at("_fields", F.lit(1)), F.array().cast("array<string>")),
                     _rows=F.slice("_fields", 2, F.greatest(F.size("_fields") - 1, F.lit(0))))
    n = F.size("_header")
    too_long = F.exists("_rows", lambda r: F.size(r) > n)
    padded = F.transform("_rows", lambda r: F.concat(
        r, F.array_repeat(F.lit(FILLER), F.greatest(n - F.size(r), F.lit(0)))))
    status = (F.when(tx.py_strip(F.col(answer_col)) == F.lit(""), F.lit("empty_answer"))
              .when(F.size("_lines") == 0, F.lit("no_table"))
              .when(F.size("_rows") == 0, F.lit("header_only"))
              .when(too_long, F.lit("parse_failed"))
              .otherwise(F.lit(STATUS_OK)))
    return d.select("filing_id",
                    (_dedupe_names(F.col("_header")) if dedupe_headers else F.col("_header")).alias("header"),
                    padded.alias("rows"), status.alias("status"), *[F.col(f"`{c}`") for c in keep])


def provenance_rows(parsed: DataFrame, provenance: tuple[str, str]) -> DataFrame:
    """TAB7: parsed tables (``header``, ``rows``) with the two named columns, filer id and filing date, at the end of
    each row. A column that a table itself calls so is replaced, as an assignment to it would. Row-local."""
    own = F.filter(F.transform("header", lambda h, i: F.when(~h.isin(PROVENANCE_COLUMNS), i)), lambda i: i.isNotNull())
    d = tx.with_once(parsed, _own=own, _more=F.array(*[F.col(f"`{c}`").cast("string") for c in provenance]))
    pick = lambda a: F.transform("_own", lambda i: F.get(a, i))
    kept = lambda a: F.when(F.size("_own") == F.size("header"), a).otherwise(pick(a))
    return d.withColumn("rows", F.transform("rows", lambda r: F.concat(kept(r), "_more"))).withColumn(
        "header", F.concat(kept(F.col("header")), F.array(*map(F.lit, PROVENANCE_COLUMNS)))).drop("_own", "_more")


def pipe_table_cells(df: DataFrame, answer_col: str = "answer", provenance: tuple[str, str] | None = None, **kw) -> DataFrame:
    """TAB1: long cells of every successfully parsed pipe table.

    ``provenance`` names two columns of ``df``, the filer id and the filing date: each row gets
    them as its last two cells (TAB7), row-locally.
    """
    p = parse_pipe_answers(df, answer_col, keep=provenance or (), **kw).where(F.col("status") == STATUS_OK)
    if provenance:
        p = provenance_rows(p, provenance)
    r = p.select("filing_id", "header", F.posexplode("rows").alias("row_no", "row"))
    c = r.select("filing_id", "row_no", "header", F.posexplode("row").alias("col_no", "value"))
    return c.select("filing_id", F.lit(1).alias("table_no"), F.col("row_no").cast("long").alias("row_no"),
                    F.col("col_no").cast("long").alias("col_no"),
                    F.element_at("header", F.col("col_no") + 1).alias("col_name"), "value")


def with_provenance(cells: DataFrame, fields: DataFrame) -> DataFrame:
    """TAB7: append ``CIK`` and ``Filing Date`` cells to every row of any long cells.

    ``fields`` holds one row per filing ``(filing_id, cik, filing_date)``. Where the answers are still at
    hand, ``pipe_table_cells(..., provenance=...)`` does the same without a shuffle.
    """
    rows = cells.groupBy("filing_id", "table_no", "row_no").agg(F.max("col_no").alias("last"))
    more = [F.struct((F.col("last") + k).cast("long").alias("col_no"), F.lit(name).alias("col_name"), F.col(c).alias("value"))
            for k, (name, c) in enumerate(zip(PROVENANCE_COLUMNS, ("cik", "filing_date"), strict=True), 1)]
    extra = rows.join(fields, "filing_id", "left").select("filing_id", "table_no", "row_no", F.inline(F.array(*more)))
    return cells.unionByName(extra)


def extraction_status(responses: DataFrame, chunks: DataFrame | None = None,
                      answer_col: str = "answer") -> DataFrame:
    """TAB6: one outcome per filing; failures are data, never task errors.

    With ``chunks`` (``filing_id, chunk``) a filing without a chunk is
    ``no_section`` (left join from the chunk side).
    """
    st = parse_pipe_answers(responses, answer_col).select("filing_id", "status")
    if chunks is None:
        return st
    return (chunks.select("filing_id", "chunk").join(st, "filing_id", "left")
            .select("filing_id", F.when(F.col("chunk").isNull(), F.lit("no_section"))
                    .otherwise(F.coalesce("status", F.lit("empty_answer"))).alias("status")))


def table_columns(cells: DataFrame) -> DataFrame:
    """``(col_name, n)``: the column names that the tables have, with their cells (one aggregation)."""
    return cells.groupBy("col_name").agg(F.count(F.lit(1)).alias("n"))


def combine_rows(tables: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """TAB5, the outer union of all tables by column name, from parsed tables ``(filing_id, table_no, header, rows)``.

    Row-local: each row's values are looked up by their place in its own table's header, which is found once a
    table; no cell is made a row and nothing is shuffled. The canonical and provenance columns, or ``columns``, are columns of the
    result, null where a table lacks them; every other name is kept in the map ``other`` (name to value). Of equal names the first counts.
    """
    cols = columns or (CANONICAL_COLUMNS + PROVENANCE_COLUMNS)
    first = lambda h, i: F.array_position("header", h) == i + 1
    rest = F.filter(F.transform("header", lambda h, i: F.when(first(h, i) & ~h.isin(cols), i)), lambda i: i.isNotNull())
    at = F.array(*[F.array_position("header", F.lit(c)).cast("int") for c in cols])
    d = tx.with_once(tables.select("filing_id", "table_no", "header", "rows"), _at=at, _rest=rest)
    d = tx.with_once(d, _names=F.transform("_rest", lambda i: F.get("header", i)))
    r = d.select("filing_id", "table_no", "_at", "_rest", "_names", F.posexplode("rows").alias("row_no", "_row"))
    # an absent name has place 0, which is no index
    named = [F.get("_row", F.get("_at", F.lit(k)) - 1).alias(c) for k, c in enumerate(cols)]
    return r.select("filing_id", "table_no", F.col("row_no").cast("long").alias("row_no"), *named,
                    F.map_from_arrays("_names", F.transform("_rest", lambda i: F.get("_row", i))).alias("other"))


def combine_tables(cells: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """TAB5 from long cells, where the tables themselves (``combine_rows``) are no longer at hand.

    One aggregation over the long cells (one shuffle on ``filing_id,
    table_no, row_no``). The canonical and provenance columns, or ``columns``,
    are columns of the result, null where a table lacks them; every other
    name that a table has is kept in the map ``other`` (name to value), so no
    cell is lost however many names there are.
    """
    cols = columns or (CANONICAL_COLUMNS + PROVENANCE_COLUMNS)
    named = [F.first(F.when(F.col("col_name") == c, F.col("value")), ignorenulls=True).alias(c) for c in cols]
    rest = F.collect_list(F.when(~F.col("col_name").isin(cols), F.struct("col_no", "col_name", "value")))
    out = cells.groupBy("filing_id", "table_no", "row_no").agg(*named, rest.alias("_rest"))
    out = out.withColumn("_rest", F.array_sort("_rest"))
    once = F.filter("_rest", lambda x, i: ~F.exists(F.slice("_rest", 1, i), lambda y: y["col_name"] == x["col_name"]))
    other = F.map_from_entries(F.transform(once, lambda x: F.struct(x["col_name"], x["value"])))
    return out.withColumn("other", other).drop("_rest")


# ------------------------------------------------------------ CSV tables ---

# One field with what stands before it (a comma or a line break; the text gets
# one in front). A quoted field runs to its closing quote, over commas and line
# breaks, with "" for a quote; without a closing quote it runs to the end.
# Possessive, so a field may have any length.
CSV_FIELD = re.compile(r'''(,|\r?\n)("(?:[^"]++|"")*+(?:"[^,\r\n]*+|\Z)|[^",\r\n][^,\r\n]*+|)''')
CSV_QUOTED = re.compile(r'"((?:[^"]++|"")*+)"')
CSV_PARSED = "struct<rows: array<array<string>>, open: boolean>"


def csv_fields(text: str) -> tuple[list[list[str]], bool]:
    """Fields of each non-blank line of a CSV text, quotes removed and doubled ones unescaped; whether a quote never closes."""
    rows: list[list[str]] = []
    unclosed = False
    for before, field in CSV_FIELD.findall("\n" + text):
        if field.startswith('"'):
            closed = CSV_QUOTED.match(field)
            unclosed = unclosed or closed is None
            field = closed[1].replace('""', '"') + field[closed.end():] if closed else ""
        if before == ",":
            rows[-1].append(field)
        else:
            rows.append([field])
    return [r for r in rows if len(r) > 1 or r[0].strip()], unclosed


def csv_rows(d: DataFrame, body_col: str) -> DataFrame:
    """Adds ``_rows`` (fields of each non-blank line) and ``_open`` (a quote that never closes) for CSV text.

    An Arrow UDF: Python finds the end of a field some ten times sooner than string expressions do, which copy a long field at each step.
    """
    @F.arrow_udf(CSV_PARSED)
    def parse(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("rows", pa.list_(pa.list_(pa.string()))), ("open", pa.bool_())])
        found = (None if t is None else csv_fields(t) for t in texts.to_pylist())
        return pa.array([f and {"rows": f[0], "open": f[1]} for f in found], kind)
    d = d.withColumn("_csv", parse(F.make_valid_utf8(F.col(body_col))))
    return tx.with_once(d, _rows=F.col("_csv.rows"), _open=F.col("_csv.open")).drop("_csv")


def csv_table_cells(df: DataFrame, answer_col: str = "answer", separator: str | None = TABLE_SEPARATOR) -> DataFrame:
    """TAB4: CSV tables split by ``---TABLE---`` into long cells.

    Each piece is stripped (a whole text is not); blank lines are skipped; the first line is the
    header (repeats renamed ``name.1``, ``name.2`` as pandas does). Quoted
    fields may hold commas, quotes and line breaks. Fields that the first row has beyond
    the header make its leading fields an index, which is not a column, as in
    pandas. A piece that is empty, leaves a quote open or has a later row with still
    more fields has no cells; ``csv_table_status`` says so. Missing trailing
    fields and NA tokens are null. ``table_no`` counts pieces from 1. Without a ``separator``
    the whole text is one table.
    """
    r = csv_table_rows(df, answer_col, separator).select("filing_id", "table_no", "header", F.posexplode("rows").alias("row_no", "row"))
    c = r.select("filing_id", "table_no", "row_no", "header", F.posexplode("row").alias("col_no", "value"))
    return c.select("filing_id", "table_no", F.col("row_no").cast("long").alias("row_no"),
                    F.col("col_no").cast("long").alias("col_no"),
                    F.element_at("header", F.col("col_no") + 1).alias("col_name"), "value")


def csv_table_rows(df: DataFrame, answer_col: str = "answer", separator: str | None = TABLE_SEPARATOR) -> DataFrame:
    """``(filing_id, table_no, header, rows)`` of each CSV table, a row a table; every row has the header's length."""
    t = _csv_tables(df, answer_col, separator).where(F.col("ok"))
    value = lambda v: F.when(~v.isin(NA_TOKENS), v)
    rows = F.transform("rows", lambda r: F.transform("header", lambda h, k: value(F.get(r, k + F.col("extra")))))
    return t.select("filing_id", "table_no", "header", rows.alias("rows"))


def csv_table_status(df: DataFrame, answer_col: str = "answer", separator: str | None = TABLE_SEPARATOR) -> DataFrame:
    return _csv_tables(df, answer_col, separator).select(
        "filing_id", "table_no", F.when(F.col("ok"), F.lit(STATUS_OK)).otherwise(F.lit("unparsable")).alias("status"))


def _csv_tables(df: DataFrame, answer_col: str, separator: str | None = TABLE_SEPARATOR) -> DataFrame:
    parts = F.transform(F.split(F.col(answer_col), separator, -1), tx.py_strip) if separator else F.array(answer_col)
    d = csv_rows(df.select("filing_id", F.posexplode(parts).alias("i", "_body")), "_body")
    d = tx.with_once(d, _header=F.coalesce(F.get("_rows", F.lit(0)), F.array().cast("array<string>")),
                     _data=F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(0))))
    extra = F.greatest(F.coalesce(F.size(F.get("_data", F.lit(0))), F.lit(0)) - F.size("_header"), F.lit(0))
    d = tx.with_once(d, _extra=extra)
    ok = (F.size("_rows") > 0) & ~F.col("_open") & ~F.exists("_data", lambda r: F.size(r) > F.size("_header") + F.col("_extra"))
    return d.select("filing_id", (F.col("i") + 1).cast("long").alias("table_no"),
                    _dedupe_names(F.col("_header"), ".", 1).alias("header"), F.col("_data").alias("rows"),
                    F.col("_extra").alias("extra"), ok.alias("ok"))


def v1_table_names(tables: DataFrame, item: str = "2") -> DataFrame:
    """SNK3 naming: ``{cik}_{filing_date}_item{n}_table{k}.csv`` per table."""
    return tables.select("filing_id", "table_no", F.format_string(
        "%s_%s_item%s_table%d.csv", F.col("cik"), F.col("filing_date"), F.lit(item),
        F.col("table_no")).alias("file_name"))


def answers_from_responses(df: DataFrame, resp_col: str = "response") -> DataFrame:
    """TXT10 over a responses table: ``(filing_id, answer)``."""
    return df.select("filing_id", answer_text(resp_col).alias("answer"))


__all__ = ["NA_TOKENS", "ANSWER_MARKER", "parse_pipe_answers", "pipe_table_cells",
           "with_provenance", "provenance_rows", "extraction_status", "combine_rows", "combine_tables", "csv_table_cells",
           "csv_table_status", "v1_table_names", "answers_from_responses"]
