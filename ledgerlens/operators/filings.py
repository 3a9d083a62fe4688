"""Filing-level operators: text, fields, sections, chunks, prompts, answers.

All operators take and return DataFrames keyed by ``filing_id`` and are
row-local (no shuffle) unless stated: a filing is processed inside the task
that scanned it, which is what lets the job scale with the number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import text as tx
from ledgerlens.functions.similarity import best_line_udf, candidates, levenshtein_ratio, ratcliff_udf

# --- fixed values (must equal the extractor's for equal prompts/results) ----
HEADER_REFERENCE = "ITEM 2. UNREGISTERED SALES OF EQUITY SECURITIES AND USE OF PROCEEDS"
SIMILARITY_THRESHOLD = 0.1
CHUNK_MAX_LINES = 12000       # named "chunk size in characters" upstream; counts lines
LINES_ABOVE = 5
CANONICAL_COLUMNS = [
    "Start Date", "End Date", "Class of Shares", "Number of Shares",
    "Average Price per Share", "Dollar Value of Shares Repurchased",
    "Total Number of Shares Purchased as Part of Publicly Announced Plans or Programs",
    "Maximum Number (or Approximate Dollar Value) of Shares that May Yet Be Purchased Under the Plans or Programs",
]
PROVENANCE_COLUMNS = ["CIK", "Filing Date"]
PROMPT_V2_HEAD = "Extract the share repurchase table from the following text chunk:\n"
PROMPT_V2_TAIL = (
    "\n\n"
    "Output only a structured table with columns:\n"
    + " | ".join(CANONICAL_COLUMNS) + "\n"
    "Fill missing data with N/A. Always include <END_OF_TABLE> at the end.\n"
    "OUTPUTT:"
)
ANSWER_MARKER = "OUTPUTT:"
END_MARKER = "<END_OF_TABLE>"
PROMPT_V1_HEAD = (
    "\nYou are an expert at extracting financial tables from SEC filings.\n"
    "Extract all tables from the following text. Return each table in CSV format.\n"
    "- Preserve all columns as headers.\n"
    "- If a cell contains a list, join values with semicolons.\n"
    "- Separate tables clearly using '---TABLE---'.\n"
    "\nText:\n"
)
PROMPT_V1_TAIL = "\n"
V1_TEXT_BUDGET = 4000
PROMPT_TOKEN_LIMIT = 4096
# --------------------------------------------------------------------------


def html_to_text(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """TXT1: visible text of each HTML filing (row-local)."""
    return df.withColumn(out, tx.html_to_text(html_col))


def filing_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """TXT2: ``(filing_id, pos, line)`` - stripped non-blank lines in order."""
    return (df.select("filing_id", F.posexplode(tx.clean_lines(text_col)).alias("pos", "line"))
            .withColumn("pos", F.col("pos").cast("long")))


def _fields_step(acc: Column, line: Column) -> Column:
    done = (acc["cik"] != F.lit("N/A")) & (acc["date"] != F.lit("N/A"))
    cik = F.when(line.contains("CIK"), F.regexp_replace(line, r"[^\p{Nd}]", "")).otherwise(acc["cik"])
    date = F.when(line.contains("Date") | line.contains("Filed"), tx.last_ws_token(line)).otherwise(acc["date"])
    return F.when(done, acc).otherwise(F.struct(cik.alias("cik"), date.alias("date")))


def filing_fields(df: DataFrame, text_col: str = "text") -> DataFrame:
    """TXT3: ``cik`` and ``filing_date`` by the ordered line scan.

    On each line containing ``CIK`` the cik becomes all digits of the line;
    on each line containing ``Date`` or ``Filed`` the date becomes its last
    token; the scan stops once neither is ``N/A``. A fold over the line
    array inside the row: no explode, no shuffle.
    """
    res = fields_struct(text_col)
    return df.select("filing_id", res["cik"].alias("cik"), res["date"].alias("filing_date"))


def fields_struct(text_col: str = "text") -> Column:
    """``struct(cik, date)`` of the line scan (column form of TXT3)."""
    init = F.struct(F.lit("N/A").alias("cik"), F.lit("N/A").alias("date"))
    return F.aggregate(tx.split_lines(text_col), init, _fields_step)


def _section_expr(text: Column, item: Column) -> Column:
    ws = tx.WS_CLASS
    start = F.regexp_instr(text, F.lit(rf"(?i)Part{ws}+II"))
    tail = F.substring(text, start, 1 << 30)
    literal = F.concat(F.lit("\\Q"), F.replace(item, F.lit("\\E"), F.lit("")), F.lit("\\E"))
    pat = F.concat(F.lit(rf"(?is)\APart{ws}+II.*Item{ws}+"), literal, F.lit(rf".*?(?=Item{ws}+\d|\n?\z)"))
    return F.when((start > 0) & (item != F.lit("")), F.call_function("regexp_extract", tail, pat, F.lit(0))).otherwise(F.lit(""))


def item_section(df: DataFrame, item: str = "2", text_col: str = "text",
                 out: str = "section", item_col: str | None = None) -> DataFrame:
    """TXT4: the part II item section (empty string = not found).

    From the first "Part II" over the last heading of the item, in either
    case, to the next item heading or the end (before one final line
    break); white space and the end of the text as Python has them. The
    text is first cut at "Part II", so a text without the item is not
    tried again from every later place. With ``item_col`` the item number,
    whatever it is, comes from each row (a manifest); a null or empty one
    is not found.
    """
    number = F.lit(item) if item_col is None else F.coalesce(F.col(item_col), F.lit(""))
    return df.withColumn(out, _section_expr(F.col(text_col), number))


def line_header_score(lines: DataFrame, header: str = HEADER_REFERENCE) -> DataFrame:
    """TXT5: Ratcliff/Obershelp score of every line against the header."""
    return lines.withColumn("score", ratcliff_udf(header)(F.col("line")))


def line_header_lev(lines: DataFrame, header: str = HEADER_REFERENCE) -> DataFrame:
    """TXT5 (native twin): Levenshtein ratio of every line against the header."""
    return lines.withColumn("score", levenshtein_ratio(F.col("line"), header))


def chunk_at(lines: Column, pos: Column, max_lines: int = CHUNK_MAX_LINES, above: int = LINES_ABOVE) -> Column:
    """The chunk of ``lines`` that starts a few lines above the line at ``pos``."""
    start = F.greatest(pos - above, F.lit(0))
    return F.array_join(F.slice(lines, start + 1, max_lines), "\n")


def with_best_line(df: DataFrame, scorer: str = "ratcliff", header: str = HEADER_REFERENCE,
                   threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Adds ``_best``, a struct of pos, score and error, from the lines in ``_lines``.

    ``ratcliff``: bounds are built-in expressions; matching and arg-max run row-locally in one Arrow UDF call per
    batch of filings, which gives a filing that it cannot score an ``error``. ``lev``: the Levenshtein ratio, the
    arg-max a fold over the line array (first maximum wins), all JVM-side.
    """
    if scorer == "ratcliff":
        d = tx.with_once(df, _c=candidates(F.col("_lines"), header, threshold))
        return d.withColumn("_best", best_line_udf(header, threshold)("_c.pos", "_c.line", "_c.bound")).drop("_c")
    scored = F.transform(F.col("_lines"), lambda l, i: F.struct(i.alias("pos"), levenshtein_ratio(l, header).alias("score")))
    init = F.struct(F.lit(-1).alias("pos"), F.lit(0.0).alias("score"))
    top = F.aggregate(scored, init, lambda acc, x: F.when(x["score"] > acc["score"], x).otherwise(acc))
    d = tx.with_once(df, _top=top)
    ok = (F.col("_top.pos") >= 0) & (F.col("_top.score") >= threshold)
    return d.withColumn("_best", F.struct(F.when(ok, F.col("_top.pos")).alias("pos"), F.when(ok, F.col("_top.score")).alias("score"),
                                          F.lit(None).cast("string").alias("error"))).drop("_top")


def best_chunk(df: DataFrame, text_col: str = "text", header: str = HEADER_REFERENCE,
               threshold: float = SIMILARITY_THRESHOLD, max_lines: int = CHUNK_MAX_LINES,
               above: int = LINES_ABOVE, scorer: str = "ratcliff") -> DataFrame:
    """TXT6: chunk of lines around the best-matching header line: ``(filing_id, best_pos, best_score, chunk)``;
    all three null when no line reaches ``threshold``. Row-local, see ``with_best_line``.

    These columns have no place for a filing that cannot be scored, whose nulls would read as "no such line", so its
    error ends the query, naming the filing; ``extraction.filing_prompts`` gives it a status instead."""
    d = tx.with_once(df.select("filing_id", text_col), _lines=tx.clean_lines(text_col))
    d = with_best_line(d, scorer, header, threshold)
    why = F.concat(F.lit("filing "), F.coalesce(F.col("filing_id").cast("string"), F.lit("null")), F.lit(" was not scored: "), F.col("_best.error"))
    best = F.when(F.col("_best.error").isNull(), F.col("_best")).otherwise(F.raise_error(why))
    return d.select("filing_id", best["pos"].alias("best_pos"), best["score"].alias("best_score"),
                    F.when(best["pos"].isNotNull(), chunk_at(F.col("_lines"), best["pos"], max_lines, above)).alias("chunk"))


def best_chunk_lev(df: DataFrame, **kw) -> DataFrame:
    """TXT6 with the Levenshtein ratio, entirely JVM-side."""
    return best_chunk(df, scorer="lev", **kw)


def prompt_v2(chunk) -> Column:
    """TXT7: the v2 extraction prompt around a chunk."""
    return F.concat(F.lit(PROMPT_V2_HEAD), tx.col_(chunk), F.lit(PROMPT_V2_TAIL))


def prompt_v1(text) -> Column:
    """TXT8: the v1 prompt: first 4000 characters of the item text."""
    return F.concat(F.lit(PROMPT_V1_HEAD), F.substring(tx.col_(text), 1, V1_TEXT_BUDGET), F.lit(PROMPT_V1_TAIL))


def truncate_tokens(text, n: int) -> Column:
    """TXT9: keep the first ``n`` whitespace tokens, original spacing kept
    (leading whitespace kept, trailing whitespace of the last kept token
    dropped)."""
    ws = tx.WS_CLASS
    nonws = ws.replace("[", "[^", 1)
    pieces = F.regexp_extract_all(tx.col_(text), F.lit(f"{nonws}+{ws}*"), 0)
    lead = F.regexp_extract(tx.col_(text), rf"\A({ws}*)", 1)
    kept = F.array_join(F.slice(pieces, 1, n), "")
    return F.concat(lead, F.regexp_replace(kept, ws + r"+\z", ""))


def prompt_v2_truncated(chunk, limit: int = PROMPT_TOKEN_LIMIT) -> Column:
    """TXT9 applied without losing the answer marker: the chunk is cut so
    that the whole prompt stays within ``limit`` whitespace tokens."""
    fixed = len((PROMPT_V2_HEAD + PROMPT_V2_TAIL).split())
    return prompt_v2(truncate_tokens(chunk, max(limit - fixed, 0)))


def extraction_prompts(df: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """TXT6 + TXT7: ``(filing_id, prompt)`` for filings with a chunk."""
    ch = best_chunk(df, text_col, **kw)
    return ch.where(F.col("chunk").isNotNull()).select("filing_id", prompt_v2("chunk").alias("prompt"))


def answer_text(resp) -> Column:
    """TXT10: text after the first ``OUTPUTT:``, stripped; whole text if absent."""
    r = tx.col_(resp)
    i = F.instr(r, ANSWER_MARKER)
    return F.when(r.isNull(), F.lit("")).when(
        i > 0, tx.py_strip(F.substring(r, i + len(ANSWER_MARKER), 1 << 30))).otherwise(r)
