"""Filing sources.

* ``scan_filing_folder``   - one row per ``*.txt`` file, whole file as text (SRC1)
* ``join_manifest``        - attach caller-supplied cik / date / item (SRC2)
* ``pages_as_filings``     - the driver's ``pages`` table seen as HTML filings
* ``derived_filings``      - filing-shaped text and HTML rendered from
                             ``orders`` + ``lineitem`` (the test data holds no
                             real filings); the same rendering exists in SQL
* ``derived_responses``    - model-answer-shaped text per filing (pipe tables)
* ``derived_csv_answers``  - v1-style answers: CSV tables split by ---TABLE---
"""

from __future__ import annotations

from urllib.parse import quote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.tables import table

#: Pages, and answers with edge cases, that one task parses.
PAGES_PER_TASK = 500
EDGES_PER_TASK = 20_000


def relative_id(path: str) -> Column:
    """Path of a scanned file below the folder ``path``: equal names in two sub-folders stay apart."""
    root = quote(urlsplit(path).path.rstrip("/"), safe="/%:@!$&'()*+,;=~") + "/"
    full, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    at = F.instr(full, root)
    return F.when(at > 0, F.url_decode(F.replace(F.substring(full, at + len(root), F.lit(1 << 20)), F.lit("+"), F.lit("%2B")))).otherwise(name)


def scan_filing_folder(spark: SparkSession, path: str, suffix: str = ".txt",
                       recursive: bool = False) -> DataFrame:
    """Whole-file scan of a folder: ``(filing_id, path, html)``; the id is the path below the folder.

    Only names ending in ``suffix`` (case-sensitive); not recursive unless
    asked. The ``wholetext`` option must be given to ``.text()`` itself: the
    method's own default would otherwise split files into lines. One file is
    one row, read by one task; nothing is listed or read on the driver.
    """
    df = (spark.read.option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", recursive)
          .text(path, wholetext=True)
          .select(relative_id(path).alias("filing_id"),
                  F.col("_metadata.file_path").alias("path"),
                  F.col("value").alias("html")))
    return df.where(F.col("filing_id").endswith(suffix))


BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def filing_files(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = True,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """``(filing_id, path, length, content)`` of the files of a folder, as bytes, so that what is no text can be told from text.

    A stream of new files if ``max_files_per_trigger`` is given, else a batch scan. Callers that filter by
    ``length`` or do without ``content`` keep the source from loading it.
    """
    reader = spark.read if max_files_per_trigger is None else spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    df = (reader.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", recursive).load(path))
    return df.select(relative_id(path).alias("filing_id"), F.col("path"), "length", "content").where(F.col("path").endswith(suffix))


def join_manifest(filings: DataFrame, manifest: DataFrame, key: str = "path",
                  broadcast_max_rows: int = 5_000_000) -> DataFrame:
    """Attach ``cik, filing_date, item_number`` from a manifest table.

    A manifest has one small row per filing; it is broadcast only when its
    row count is under ``broadcast_max_rows`` (checked), otherwise both sides
    are shuffled on the key by a regular sort-merge join.
    """
    n = manifest.count()
    m = F.broadcast(manifest) if n <= broadcast_max_rows else manifest
    return filings.join(m, key, "inner")


def pages_as_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as ``(filing_id, html)``."""
    return table(spark, sf_dir, "pages", PAGES_PER_TASK).select(
        F.col("page_id").cast("string").alias("filing_id"), F.col("html"))


def _d(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def _money(c) -> F.Column:
    return c.cast("decimal(18,2)").cast("string")


def _order_lines(spark: SparkSession, sf_dir: str, **row_fmts) -> DataFrame:
    """Per order: its lineitems rendered by each of ``row_fmts`` and joined by newline
    in line-number order. One shuffle of lineitem by order key; groups are
    one order's lines (bounded)."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select("l_orderkey", "l_linenumber", *[f(li).alias(n) for n, f in row_fmts.items()])

    def joined(name):
        # ties on the line number are ordered by the rendered row (stable result)
        lines = F.sort_array(F.collect_list(F.struct("l_linenumber", F.col(name).alias("row"))))
        return F.array_join(lines["row"], "\n").alias(name)
    return rows.groupBy("l_orderkey").agg(*[joined(n) for n in row_fmts])


def derived_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing text per order: ``(filing_id, text)``.

    Variation by order attributes gives every branch of the section and
    field rules real rows: a missing part II, a non-breaking space inside
    "Part II", a section running to the end, an "Item 20", a missing CIK
    line, a date of ``N/A``.
    """
    o = table(spark, sf_dir, "orders")
    body = _order_lines(spark, sf_dir, body=_purchase_line)
    return (o.join(body, o.o_orderkey == body.l_orderkey, "left")
            .select(o.o_orderkey.cast("string").alias("filing_id"), _filing_text(o, F.col("body")).alias("text")))


def _purchase_line(li: DataFrame) -> Column:
    return F.concat_ws(" ", F.lit("Purchase"), li.l_linenumber.cast("string"), F.lit("of"), _money(li.l_quantity),
                       F.lit("shares at"), _money(li.l_extendedprice), F.lit("on"), _d(li.l_shipdate))


def _filing_text(o: DataFrame, body: Column) -> Column:
    pr = o.o_orderpriority
    part2 = (F.when(pr == "1-URGENT", F.lit(""))
             .when(pr == "2-HIGH", F.lit("PART\u00a0II. OTHER INFORMATION\n"))
             .otherwise(F.lit("Part II - Other Information\n")))
    item2 = F.when(pr == "4-NOT SPECIFIED", F.lit("Item 20")).otherwise(F.lit("ITEM 2"))
    tail = F.when(pr == "3-MEDIUM", F.lit("")).otherwise(F.lit("Item 3. Defaults Upon Senior Securities\nNone.\n"))
    cik = F.when(pr == "5-LOW", F.lit("")).otherwise(
        F.concat(F.lit("CENTRAL INDEX KEY: CIK "), F.lpad(o.o_custkey.cast("string"), 10, "0"), F.lit("\n")))
    date = F.when(o.o_orderstatus == "P", F.lit("N/A")).otherwise(_d(o.o_orderdate))
    return F.concat(
        F.lit("QUARTERLY REPORT "), o.o_orderkey.cast("string"), F.lit("\n"),
        cik,
        F.lit("FILED AS OF Date: "), date, F.lit("\n"),
        F.lit("PART I - FINANCIAL INFORMATION\nItem 1. Financial Statements\nTotal "),
        _money(o.o_totalprice), F.lit("\n"),
        part2,
        F.lit("Item 1. Legal Proceedings\nNone.\n"),
        item2, F.lit(". Unregistered Sales of Equity Securities and Use of Proceeds\n"),
        F.coalesce(body, F.lit("")), F.lit("\n"),
        tail)


def derived_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model answer per order: ``(filing_id, response)``.

    Shapes: the usual echo + ``OUTPUTT:`` + pipe table + ``<END_OF_TABLE>``;
    short rows (padded), over-long rows (parse failure), answers without a
    table, empty answers and answers without the marker.
    """
    o = table(spark, sf_dir, "orders")
    body = _order_lines(spark, sf_dir, body=_answer_line)
    return (o.join(body, o.o_orderkey == body.l_orderkey, "left")
            .select(o.o_orderkey.cast("string").alias("filing_id"), _response(o, F.col("body")).alias("response")))


def derived_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with the answers that a model gave for them, as a run keeps them: ``(filing_id, text, response)``."""
    o = table(spark, sf_dir, "orders")
    body = _order_lines(spark, sf_dir, purchases=_purchase_line, answer=_answer_line)
    return (o.join(body, o.o_orderkey == body.l_orderkey, "left")
            .select(o.o_orderkey.cast("string").alias("filing_id"), _filing_text(o, F.col("purchases")).alias("text"),
                    _response(o, F.col("answer")).alias("response")))


def _answer_line(li: DataFrame) -> Column:
    base = [F.lit(""), _d(li.l_shipdate), _d(F.date_add(li.l_shipdate, 30)),
            F.concat(F.lit("Class "), li.l_returnflag), _money(li.l_quantity)]
    full = F.concat_ws(" | ", *base, _money(li.l_extendedprice), F.lit(""))
    short = F.concat_ws(" | ", *base, F.lit(""))
    long = F.concat_ws(" | ", *base, _money(li.l_extendedprice), _money(li.l_tax), F.lit(""))
    return F.trim(F.when(li.l_linestatus == "F", short)
                  .when((li.l_returnflag == "R") & (li.l_linenumber == 7), long)
                  .otherwise(full))


def _response(o: DataFrame, body: Column) -> Column:
    header = ("| Start Date | End Date | Class of Shares | Number of Shares | "
              "Dollar Value of Shares Repurchased |\n|---|---|---|---|---|\n")
    table_txt = F.concat(F.lit(header), F.coalesce(body, F.lit("")),
                         F.lit("\n<END_OF_TABLE>\n| trailing | junk |"))
    pr, st = o.o_orderpriority, o.o_orderstatus
    return (F.when(st == "P", F.lit(""))
            .when(pr == "1-URGENT", F.lit("Extract the table.\nOUTPUTT:\nNo repurchases were reported."))
            .when(pr == "2-HIGH", F.concat(F.lit("Extract the table.\nOUTPUTT:\n"), F.lit(header)))
            .when(pr == "5-LOW", table_txt)
            .otherwise(F.concat(F.lit("Extract the table.\nOUTPUTT:\n"), table_txt)))


def derived_csv_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1-style answers: ``(filing_id, answer)`` holding CSV tables split by
    ``---TABLE---``: a line table with a quoted comma and a ``;`` list cell,
    a summary table, and (for some orders) an unparsable fragment."""
    o = table(spark, sf_dir, "orders")
    body = _order_lines(spark, sf_dir, body=lambda li: F.concat_ws(
        ",", li.l_linenumber.cast("string"), _money(li.l_quantity),
        F.concat(F.lit('"'), li.l_returnflag, F.lit(","), li.l_linestatus, F.lit('"')),
        F.concat(_d(li.l_shipdate), F.lit(";"), _d(F.date_add(li.l_shipdate, 1)))))
    t1 = F.concat(F.lit("line,quantity,flags,dates\n"), F.coalesce(F.col("body"), F.lit("")))
    t2 = F.concat(F.lit("metric,value\ntotal,"), _money(o.o_totalprice),
                  F.lit("\npriority,"), o.o_orderpriority)
    bad = F.when(o.o_orderstatus == "F", F.lit("\n---TABLE---\na,b\n1,2,3\n")).otherwise(F.lit(""))
    ans = F.concat(F.lit("\n"), t1, F.lit("\n---TABLE---\n"), t2, bad)
    return (o.join(body, o.o_orderkey == body.l_orderkey, "left")
            .select(o.o_orderkey.cast("string").alias("filing_id"), ans.alias("answer")))


def derived_csv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose CSV has an empty first field, a short row, quotes with commas, quotes and line breaks
    inside, a field of 50,000 characters (for some), a row that is too long and a quote that never closes."""
    o = table(spark, sf_dir, "orders", EDGES_PER_TASK)
    key = o.o_orderkey.cast("string")
    long = F.when((o.o_orderpriority == "1-URGENT") & (o.o_orderstatus == "P"), F.rpad(F.lit("x"), 50000, "x")).otherwise(F.lit("x"))
    t1 = F.concat(F.lit("key,name,note\n,"), key, F.lit(",b\n"), key, F.lit('\n1,"p ""'), key, F.lit('""\nq, r",'), F.lit('"'), long, F.lit('"\n'))
    t2 = F.concat(F.lit("a,b\n1,"), key, F.lit(",3\n4\n"))
    t3 = F.concat(F.lit("a,b\n1,2\n1,2,"), key)
    t4 = F.concat(F.lit('a,b\n1,"never closed '), key)
    sep = F.lit("\n---TABLE---\n")
    return o.select(key.alias("filing_id"), F.concat(t1, sep, t2, sep, t3, sep, t4).alias("answer"))


def derived_html_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML filings with a print-style repurchase table per order:
    ``(filing_id, html)``. Stacked header rows with ``colspan=3`` over
    spacer cells (as filings lay them out), then one data row per lineitem
    with the currency sign in its own cell; urgent orders open with a row without numbers."""
    o = table(spark, sf_dir, "orders")
    sp = "<td>&nbsp;</td>"

    head = ("<tr><td width=\"50%\">&nbsp;</td>" + sp * 8 + "</tr>"
            + "<tr><td>&nbsp;</td>" + "".join(f"{sp}<td colspan=\"3\"><b>{x}</b></td>" for x in
                                              ("Total Number", "Average", "Total Number of Shares")) + "</tr>"
            + "<tr><td><b>Period</b></td>" + "".join(f"{sp}<td colspan=\"3\"><b>{x}</b></td>" for x in
                                                     ("of Shares Purchased", "Price Paid per Share",
                                                      "Purchased as Part of Programs")) + "</tr>")
    opening = ("<tr><td>Opening</td>" + sp + "<td>&nbsp;</td><td>N/A</td><td>&nbsp;</td>" + sp + "<td>$</td><td>&#151;</td><td>&nbsp;</td>"
               + sp + "<td>&nbsp;</td><td>-</td><td>&nbsp;</td></tr>")
    body = _order_lines(spark, sf_dir, body=lambda li: F.concat(
        F.lit("<tr><td>"), _d(li.l_shipdate), F.lit("</td>" + sp + "<td>&nbsp;</td><td>"),
        _money(li.l_quantity), F.lit("</td><td>&nbsp;</td>" + sp + "<td>$</td><td>"),
        _money(li.l_extendedprice), F.lit("</td><td>&nbsp;</td>" + sp + "<td>&nbsp;</td><td>"),
        li.l_linenumber.cast("string"), F.lit("</td><td>&nbsp;</td></tr>")))
    html = F.concat(
        F.lit("<html><head><style>td{padding:0}</style><script>var x='<table>';</script></head><body>"
              "<p>PART II &#151; OTHER INFORMATION</p>"
              "<p><b>ITEM 2. UNREGISTERED SALES OF EQUITY SECURITIES AND USE OF PROCEEDS</b></p>"
              "<table cellspacing=\"0\"><!-- Begin Table Head -->"), F.lit(head),
        F.lit("<!-- End Table Head -->"), F.when(o.o_orderpriority == "1-URGENT", F.lit(opening)).otherwise(F.lit("")),
        F.coalesce(F.col("body"), F.lit("")),
        F.lit("</table><p>Total "), _money(o.o_totalprice), F.lit("</p></body></html>"))
    return (o.join(body, o.o_orderkey == body.l_orderkey, "left")
            .select(o.o_orderkey.cast("string").alias("filing_id"), html.alias("html")))


def derived_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filing manifest per order: ``(path, cik, filing_date, item_number)``."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("filings/"), o.o_orderkey.cast("string"), F.lit(".txt")).alias("path"),
                    F.lpad(o.o_custkey.cast("string"), 10, "0").alias("cik"),
                    _d(o.o_orderdate).alias("filing_date"),
                    F.when(o.o_orderpriority.startswith("1"), F.lit("5")).otherwise(F.lit("2")).alias("item_number"))
