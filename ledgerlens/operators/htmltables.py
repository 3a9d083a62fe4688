"""Rule-based HTML table extraction (TAB8) and header mapping (TAB9).

Filings lay tables out for print: stacked header rows, ``colspan`` over
spacer columns, ``&nbsp;`` fillers, currency signs in their own cells. The
rules here, all row-local (one filing's tables never leave its task):

1. every table is read, a nested one on its own and not as text of the
   table around it; tables are numbered as they open;
2. rows ``<tr``..``</tr``; cells ``<td|th ...>``..``</td|th``; cell text =
   tags removed, references decoded, whitespace collapsed;
3. each cell covers ``colspan`` grid columns from the first one that the
   cells before it and the cells reaching down (``rowspan``) leave free;
4. header rows = rows before the first data row: one with a numeric cell, or one that has a label
   in its first cell and nothing but marks of a missing value (a dash, ``N/A``, ``none``) after it, where a row
   whose numbers are all years, with another row to follow, is a header too; without
   any numeric row the first row is the header, or, where cells span columns as in stacked heads,
   all rows are. The label of a grid column = the texts of the
   header cells covering it, top to bottom, joined by a space;
5. a data cell belongs to the column group of its start: the grid columns
   that the same header cells cover; non-blank cells of one group in a row are
   joined by a space (``$`` + ``12.50``). Groups with equal labels are told
   apart by ``_2``, ``_3``.

Output: ``(filing_id, table_no, row_no, col_no, col_name, value)``.
"""

from __future__ import annotations

import html
import re
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.functions import text as tx
from ledgerlens.functions.assignment import assign
from ledgerlens.operators.filings import CANONICAL_COLUMNS

NUMERIC_CELL = r"^[$(]*\s*-?[0-9][0-9,]*(\.[0-9]+)?\)?%?$"
# comments, scripts and styles removed in one pass over the document
NON_TEXT = (r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*>.*?(?:</script\s*>|\z)"
            r"|style\b[^>]*>.*?(?:</style\s*>|\z))")


GRID_CELL = T.ArrayType(T.StructType([
    T.StructField("row_no", T.LongType()), T.StructField("col_no", T.LongType()),
    T.StructField("col_name", T.StringType()), T.StructField("value", T.StringType())]))

TABLES = T.ArrayType(T.StructType([T.StructField("table_no", T.LongType()), T.StructField("cells", GRID_CELL)]))

_TABLE_RE = re.compile(r"(?i)<(/?)table\b[^>]*>")
_ROW_RE = re.compile(r"(?i)<tr\b[^>]*>")
_ROW_END = re.compile(r"(?i)</tr\s*>")
_CELL_RE = re.compile(r"(?i)<t[dh]\b([^>]*)>")
_CELL_END = re.compile(r"(?i)</t[dh]\s*>")
_SPAN_RE = re.compile(r"""(?i)\b(col|row)span\s*=\s*["']?([0-9]+)""")
_TAG_RE = re.compile(tx.TAG)
_NUM_RE = re.compile(NUMERIC_CELL)
_MISSING_RE = re.compile(r"(?i)(?:\(?[-\u2010-\u2015\u2212]+\)?|n/?a|nil|none)%?$")
_UNIT_RE = re.compile(r"[$\u20ac\u00a3\u00a5%)(]+$")
_YEAR_RE = re.compile(r"(?:19|20)[0-9]{2}$")
#: Rows and columns that a span can cover.
MOST_SPAN = 1000

Cell = tuple[int, int, str]  # first grid column, columns, text


def table_bodies(h: str) -> list[tuple[int, str]]:
    """(number, markup) of every table, without the tables nested in it."""
    out, open_, number, at = [], [], 0, 0
    for m in _TABLE_RE.finditer(h):
        if open_:
            open_[-1][1].append(h[at : m.start()])
        at = m.end()
        if not m[1]:
            number += 1
            open_.append((number, []))
        elif open_:
            out.append(open_.pop())
    if open_:
        open_[-1][1].append(h[at:])
    return sorted((n, " ".join(parts)) for n, parts in out + open_)


def _before(end: re.Pattern, s: str) -> str:
    m = end.search(s)
    return s[:m.start()] if m else s


def _cell_text(body: str) -> str:
    """Text of a cell's markup; what has no tag or reference is not searched for it."""
    text = body.partition("</td>")[0]
    if not text or text == "&nbsp;":  # a filler
        return ""
    if "<" in text:
        text = _before(_CELL_END, body)
        if "<" in text:
            text = _TAG_RE.sub(" ", text)
    if "&" in text:
        text = text.replace("&nbsp;", " ")  # white space either way
        if "&" in text:
            text = html.unescape(text)
    return " ".join(text.split())


def grid_rows(t: str) -> list[list[Cell]]:
    """Rows with any text; a cell that reaches down stands in each of its rows."""
    rows, reach = [], {}  # reach: grid column -> (rows left, cell)
    for piece in _ROW_RE.split(t)[1:]:
        parts = _CELL_RE.split(_before(_ROW_END, piece))  # [before, attributes, body, attributes, body, ...]
        if not reach and not any("span" in x.lower() for x in parts[1::2] if x):
            cells = [(at, 1, _cell_text(body)) for at, body in enumerate(parts[2::2])]
            if any(c[2] for c in cells):
                rows.append(cells)
            continue
        cells, at, down = [], 0, {}
        if reach:
            cells = [c for p, (_, c) in reach.items() if p == c[0]]
            reach = {p: (n - 1, c) for p, (n, c) in reach.items()}
        for attributes, body in zip(parts[1::2], parts[2::2], strict=True):
            spans = {m[0].lower(): min(max(int(m[1]), 1), MOST_SPAN) for m in _SPAN_RE.findall(attributes)} if attributes else {}
            while at in reach:
                at += 1
            cell = (at, spans.get("col", 1), _cell_text(body))
            cells.append(cell)
            if (more := spans.get("row", 1) - 1):
                down |= {p: (more, cell) for p in range(at, at + cell[1])}
            at += cell[1]
        if reach or down:
            reach = {p: x for p, x in reach.items() if x[0] > 0} | down
        if any(c[2] for c in cells):
            rows.append(sorted(cells))
    return rows


def _all_missing(r: list[Cell]) -> bool:
    """A label, and after it marks of missing values alone, at least one."""
    label, *rest = (c[2] for c in r)
    values = [x for x in rest if x and not _UNIT_RE.match(x)]
    return bool(label) and not _MISSING_RE.match(label) and bool(values) and all(map(_MISSING_RE.match, values))


def _first_data_row(rows: list[list[Cell]]) -> int:
    for i, r in enumerate(rows):
        if i and _all_missing(r):
            return i
        numbers = [c[2] for c in r if _NUM_RE.match(c[2])]
        if numbers and not (all(map(_YEAR_RE.match, numbers)) and i + 1 < len(rows) and not _NUM_RE.match(r[0][2])
                            and any(_NUM_RE.match(c[2]) for c in rows[i + 1])):
            return i
    return len(rows) if any(c[1] > 1 for r in rows for c in r) else 1


def parse_table_grid(t: str) -> list[dict]:
    """Rules 2-5 of the module doc for one table body (plain Python)."""
    rows = grid_rows(t)
    first = _first_data_row(rows)
    groups, names = {}, {}
    # header cells over each grid column that a data cell starts in, from the top
    heads = [c for r in rows[:first] for c in r if c[2]]
    for p in sorted({c[0] for r in rows[first:] for c in r if c[2]}):
        # names are given in the order of first use from the left
        g = groups[p] = tuple(dict.fromkeys(c for c in heads if c[0] <= p < c[0] + c[1])) or (p,)
        if g not in names:
            label = " ".join(c[2] for c in g if isinstance(c, tuple)) or f"col_{p}"
            same = sum(x == label for x, _ in names.values())
            names[g] = (label, label if not same else f"{label}_{same + 1}")
    place = {p: names[g][1] for p, g in groups.items()}
    out = []
    for rn, r in enumerate(rows[first:]):
        found: dict[tuple, tuple[int, list[str]]] = {}
        for start, _, text in r:
            if text:
                found.setdefault(groups[start], (start, []))[1].append(text)
        out += [{"row_no": rn, "col_no": start, "col_name": place[start], "value": " ".join(texts)}
                for start, texts in found.values()]
    return out


TABLES_ARROW = to_arrow_type(TABLES)


@F.arrow_udf(TABLES)
def _tables_udf(pages: pa.Array) -> pa.Array:
    return pa.array([[{"table_no": n, "cells": parse_table_grid(t)} for n, t in table_bodies(h or "")] for h in pages.to_pylist()], TABLES_ARROW)


def _tables(df: DataFrame, html_col: str) -> DataFrame:
    page = F.regexp_replace(F.col(html_col), NON_TEXT, "")
    return df.select("filing_id", F.explode(_tables_udf(page)).alias("t")).select("filing_id", "t.table_no", "t.cells")


def html_table_cells(df: DataFrame, html_col: str = "html") -> DataFrame:
    """TAB8 (see module doc): comments, scripts and styles go by one regex, the grid rules run in an
    Arrow UDF over the filings of a task. ``html_table_status`` has a row for each table."""
    return (_tables(df, html_col).select("filing_id", "table_no", F.explode("cells").alias("c"))
            .select("filing_id", "table_no", "c.row_no", "c.col_no", "c.col_name", "c.value"))


def html_table_status(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``(filing_id, table_no, status)`` of every table: ``ok``, or ``no_data`` without a data row."""
    return _tables(df, html_col).select(
        "filing_id", "table_no", F.when(F.size("cells") > 0, F.lit("ok")).otherwise(F.lit("no_data")).alias("status"))


CANON_SCHEMA = T.StructType([T.StructField("canonical", T.StringType()),
                             T.StructField("score", T.DoubleType())])


def _scores(header: str, low: list[str]) -> list[float]:
    sm = SequenceMatcher(None, header.lower(), "")
    out = []
    for n in low:
        sm.set_seq2(n)
        out.append(sm.ratio())
    return out


def canonical_header_udf(names: list[str] = CANONICAL_COLUMNS, threshold: float = 0.5):
    """pandas UDF: free header text -> (best canonical name or null, score)
    by the Ratcliff/Obershelp ratio of lower-cased strings; the canonical
    list is a fixed parameter, scored inside the task (no join)."""
    low = [n.lower() for n in names]

    @F.pandas_udf(CANON_SCHEMA)
    def _map(h: pd.Series) -> pd.DataFrame:
        best_n, best_s = [], []
        for s in h:
            if s is None:
                best_n.append(None)
                best_s.append(None)
                continue
            scores = _scores(s, low)
            k = max(range(len(scores)), key=lambda j: (scores[j], -j))
            best_n.append(names[k] if scores[k] >= threshold else None)
            best_s.append(scores[k])
        return pd.DataFrame({"canonical": best_n, "score": best_s})

    return _map


def canonical_columns(cells: DataFrame, threshold: float = 0.5) -> DataFrame:
    """TAB9: distinct extracted header names mapped to the canonical columns."""
    names = cells.select("col_name").distinct()
    m = canonical_header_udf(threshold=threshold)(F.col("col_name"))
    return names.select("col_name", m["canonical"].alias("canonical"), m["score"].alias("score"))


def assigned_names_udf(names: list[str] = CANONICAL_COLUMNS, threshold: float = 0.5):
    """pandas UDF: the headers of a table -> the names that its columns take.

    Headers and canonical names are matched one to one with the greatest sum of ratios (``assignment.assign``, which says
    what ties do); a header without a match keeps its own name, with ``_2``, ``_3`` if that is taken.
    """
    low = [n.lower() for n in names]

    @F.pandas_udf("array<string>")
    def _assign(tables: pd.Series) -> pd.Series:
        memo: dict[str, list[float]] = {}
        known: dict[tuple, list[str]] = {}
        out = []
        for headers in tables:
            key = tuple(headers)
            if key not in known:
                for h in key:
                    memo.setdefault(h, _scores(h, low))
                taken = [names[j] if j is not None else None for j in assign([memo[h] for h in key], threshold)]
                used = {t for t in taken if t}
                for k, h in enumerate(key):
                    if taken[k] is None:
                        free = next(x for x in (h, *(f"{h}_{i}" for i in range(2, len(key) + 2 + len(names)))) if x not in used)
                        taken[k] = free
                        used.add(free)
                known[key] = taken
            out.append(known[key])
        return pd.Series(out, dtype=object)

    return _assign


def canonical_cells(df: DataFrame, html_col: str = "html", names: list[str] = CANONICAL_COLUMNS, threshold: float = 0.5) -> DataFrame:
    """TAB8 with TAB9 applied: cells under canonical names, and the ``header`` each had, so that ``combine_tables`` gets
    canonical columns. Row-local: a table's headers are assigned together before its cells become rows."""
    t = _tables(df, html_col).withColumn("_headers", F.array_distinct(F.transform("cells", lambda c: c["col_name"])))
    t = t.withColumn("_names", assigned_names_udf(names, threshold)("_headers"))
    c = t.select("filing_id", "table_no", "_headers", "_names", F.explode("cells").alias("c"))
    return c.select("filing_id", "table_no", "c.row_no", "c.col_no", F.col("c.col_name").alias("header"),
                    F.element_at("_names", F.array_position("_headers", F.col("c.col_name")).cast("int")).alias("col_name"), "c.value")
