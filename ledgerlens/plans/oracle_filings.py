"""Oracle SQL for the filing queries (text, fields, sections, chunks,
prompts, answers, pipe and CSV tables)."""

from __future__ import annotations

from ledgerlens.functions import text as tx
from ledgerlens.operators import filings as fo
from ledgerlens.operators.tables import NA_TOKENS, TABLE_SEPARATOR
from ledgerlens.plans import sqltext as S

q = S.q
NL = "chr(10)"


# The patterns of the SQL side are its own.
_REF = "&(?:#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_TAG = """</?[A-Za-z](?:[^<>"']|"[^"<]*"|'[^'<]*')*>|</?[A-Za-z][^<>]*>"""
#: What the references of the given and rendered texts stand for.
_CHARS = {"&amp;": "&", "&amp": "&", "&copy;": "©", "&middot;": "·", "&quot;": '"', "&lt;": "<", "&gt;": ">",
          "&nbsp;": "\u00a0", "&#151;": "—", "&#160;": "\u00a0", "&#8212;": "—", "&#8217;": "’"}


def decode_entities(x: str) -> str:
    one = "CASE r " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in _CHARS.items()) + " ELSE r END"
    refs = f"list_transform(regexp_extract_all({x}, {q(_REF)}), lambda r: {one})"
    pieces = f"string_split_regex({x}, {q(_REF)})"
    joined = f"array_to_string(list_transform(list_zip({pieces}, {refs}), lambda p: p[1] || coalesce(p[2], '')), '')"
    return f"(CASE WHEN strpos({x}, '&') > 0 THEN {joined} ELSE {x} END)"


def html_to_text(x: str) -> str:
    s = f"regexp_replace({x}, {q(tx.COMMENT)}, '', 'g')"
    for t in ("script", "style", "template"):
        s = f"regexp_replace({s}, {q(rf'(?is)<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)')}, '', 'g')"
    s = f"regexp_replace({s}, {q(tx.DECL)}, '', 'g')"
    nodes = f"list_filter(string_split_regex({s}, {q(_TAG)}), lambda z: z <> '')"
    return decode_entities(f"array_to_string({nodes}, {NL})")


PAGES_TEXT = f"SELECT CAST(page_id AS VARCHAR) AS filing_id, {html_to_text('html')} AS text FROM pages"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def _d(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def order_lines(row_expr: str) -> str:
    return (f"SELECT l_orderkey, string_agg(row, {NL} ORDER BY l_linenumber, row) AS body FROM "
            f"(SELECT l_orderkey, l_linenumber, {row_expr} AS row FROM lineitem) GROUP BY l_orderkey")


def derived_filings() -> str:
    body = order_lines("concat_ws(' ', 'Purchase', CAST(l_linenumber AS VARCHAR), 'of', "
                       f"{_money('l_quantity')}, 'shares at', {_money('l_extendedprice')}, 'on', {_d('l_shipdate')})")
    part2 = ("CASE WHEN o_orderpriority = '1-URGENT' THEN '' "
             "WHEN o_orderpriority = '2-HIGH' THEN 'PART' || chr(160) || 'II. OTHER INFORMATION' || chr(10) "
             "ELSE 'Part II - Other Information' || chr(10) END")
    item2 = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Item 20' ELSE 'ITEM 2' END"
    tail = ("CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' "
            "ELSE 'Item 3. Defaults Upon Senior Securities' || chr(10) || 'None.' || chr(10) END")
    cik = ("CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'CENTRAL INDEX KEY: CIK ' || "
           "lpad(CAST(o_custkey AS VARCHAR), 10, '0') || chr(10) END")
    date = f"CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE {_d('o_orderdate')} END"
    text = (f"'QUARTERLY REPORT ' || CAST(o_orderkey AS VARCHAR) || chr(10) || {cik} || "
            f"'FILED AS OF Date: ' || {date} || chr(10) || "
            f"'PART I - FINANCIAL INFORMATION' || chr(10) || 'Item 1. Financial Statements' || chr(10) || 'Total ' || "
            f"{_money('o_totalprice')} || chr(10) || {part2} || "
            f"'Item 1. Legal Proceedings' || chr(10) || 'None.' || chr(10) || {item2} || "
            f"'. Unregistered Sales of Equity Securities and Use of Proceeds' || chr(10) || "
            f"coalesce(b.body, '') || chr(10) || {tail}")
    return (f"SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, {text} AS text "
            f"FROM orders o LEFT JOIN ({body}) b ON o.o_orderkey = b.l_orderkey")


def derived_responses() -> str:
    base = (f"'', {_d('l_shipdate')}, {_d('l_shipdate + INTERVAL 30 DAY')}, 'Class ' || l_returnflag, "
            f"{_money('l_quantity')}")
    full = f"concat_ws(' | ', {base}, {_money('l_extendedprice')}, '')"
    short = f"concat_ws(' | ', {base}, '')"
    long = f"concat_ws(' | ', {base}, {_money('l_extendedprice')}, {_money('l_tax')}, '')"
    row = (f"trim(CASE WHEN l_linestatus = 'F' THEN {short} "
           f"WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN {long} ELSE {full} END)")
    body = order_lines(row)
    header = ("| Start Date | End Date | Class of Shares | Number of Shares | "
              "Dollar Value of Shares Repurchased |\n|---|---|---|---|---|\n")
    table_txt = f"({q(header)} || coalesce(b.body, '') || {q(chr(10) + '<END_OF_TABLE>' + chr(10) + '| trailing | junk |')})"
    lead = q("Extract the table.\nOUTPUTT:\n")
    resp = (f"CASE WHEN o_orderstatus = 'P' THEN '' "
            f"WHEN o_orderpriority = '1-URGENT' THEN {q('Extract the table.' + chr(10) + 'OUTPUTT:' + chr(10) + 'No repurchases were reported.')} "
            f"WHEN o_orderpriority = '2-HIGH' THEN {lead} || {q(header)} "
            f"WHEN o_orderpriority = '5-LOW' THEN {table_txt} "
            f"ELSE {lead} || {table_txt} END")
    return (f"SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, {resp} AS response "
            f"FROM orders o LEFT JOIN ({body}) b ON o.o_orderkey = b.l_orderkey")


def derived_csv_answers() -> str:
    body = order_lines(f"concat_ws(',', CAST(l_linenumber AS VARCHAR), {_money('l_quantity')}, "
                       f"'\"' || l_returnflag || ',' || l_linestatus || '\"', "
                       f"{_d('l_shipdate')} || ';' || {_d('l_shipdate + INTERVAL 1 DAY')})")
    t1 = f"('line,quantity,flags,dates' || chr(10) || coalesce(b.body, ''))"
    t2 = (f"('metric,value' || chr(10) || 'total,' || {_money('o_totalprice')} || chr(10) || "
          f"'priority,' || o_orderpriority)")
    bad = f"CASE WHEN o_orderstatus = 'F' THEN {q(chr(10) + '---TABLE---' + chr(10) + 'a,b' + chr(10) + '1,2,3' + chr(10))} ELSE '' END"
    ans = f"chr(10) || {t1} || {q(chr(10) + '---TABLE---' + chr(10))} || {t2} || {bad}"
    return (f"SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, {ans} AS answer "
            f"FROM orders o LEFT JOIN ({body}) b ON o.o_orderkey = b.l_orderkey")


def answer_text(r: str) -> str:
    m = q(fo.ANSWER_MARKER)
    return (f"CASE WHEN {r} IS NULL THEN '' WHEN strpos({r}, {m}) > 0 THEN "
            f"{S.strip(f'substr({r}, strpos({r}, {m}) + {len(fo.ANSWER_MARKER)})')} ELSE {r} END")


def last_ws_token(x: str) -> str:
    return f"regexp_extract({x}, {q('(' + S.NONWS + '+)' + S.WS + '*' + chr(92) + 'z')}, 1)"


def filing_fields() -> str:
    return fields(derived_filings())


def item_section(item: str = "2") -> str:
    ws = S.WS
    pat = rf"(?is)(Part{ws}+II.*Item{ws}+{item}.*?)(?:Item{ws}+\d|\n?\z)"
    return f"SELECT filing_id, text, regexp_extract(text, {q(pat)}, 1) AS section FROM ({derived_filings()})"


def lev_ratio(x: str, header: str = fo.HEADER_REFERENCE) -> str:
    folded = f"lower(regexp_replace({x}, '[^\\x00-\\x7F]', '?', 'g'))"
    m = f"greatest(length({folded}), {len(header)})"
    return f"(CASE WHEN {m} = 0 THEN 1.0 ELSE 1.0 - levenshtein({folded}, {q(header.lower())}) / {m} END)"


def filing_lines_sql(src: str = PAGES_TEXT) -> str:
    return (f"SELECT filing_id, CAST(pos - 1 AS BIGINT) AS pos, line FROM ("
            f"SELECT filing_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM ("
            f"SELECT filing_id, {S.clean_lines('text')} AS ls FROM ({src})))")


def _longest_match(src: str) -> str:
    """Adds the longest common block of ``a`` and ``b``: its length k, the first place i in a, and the first place j in b for that."""
    lens = ("list_transform(range(1, length(a) + 1), lambda i: coalesce(list_max(list_filter("
            "range(1, least(length(a) - i + 1, length(b)) + 1), lambda n: contains(b, substr(a, i, n)))), 0))")
    return (f"SELECT line, a, b, k, i, strpos(b, substr(a, i, k)) AS j FROM ("
            f"SELECT *, list_max(lens) AS k, list_position(lens, list_max(lens)) AS i FROM (SELECT *, {lens} AS lens FROM ({src})))")


def ratcliff_scores(lines: str, header: str = fo.HEADER_REFERENCE) -> str:
    """CTEs ending in ``score (line, score)``: matched blocks by recursion to the left and to the right of the longest one."""
    base = _longest_match(f"SELECT line, lower(line) AS a, {q(header.lower())} AS b FROM (SELECT DISTINCT line FROM ({lines}))")
    sides = ("SELECT line, unnest([substr(a, 1, i - 1), substr(a, i + k)]) AS a, unnest([substr(b, 1, j - 1), substr(b, j + k)]) AS b "
             "FROM block WHERE k > 0")
    more = _longest_match(f"SELECT * FROM ({sides}) WHERE a <> '' AND b <> ''")
    return (f"block AS ({base} UNION ALL {more}), "
            f"score AS (SELECT line, 2.0 * sum(k) / (length(lower(line)) + {len(header)}) AS score FROM block GROUP BY line)")


def line_header_score(src: str = PAGES_TEXT) -> str:
    return (f"WITH RECURSIVE l AS ({filing_lines_sql(src)}), {ratcliff_scores('SELECT line FROM l')} "
            "SELECT filing_id, pos, l.line, CAST(score AS DOUBLE) AS score FROM l JOIN score ON score.line = l.line")


def chunks(src: str, scored: str, rounded: bool = True) -> str:
    """The chunk of each filing of ``src`` from ``scored``, a query of (filing_id, pos, score)."""
    return f"""
SELECT f.filing_id, b.pos AS best_pos, {'round(b.score, 6)' if rounded else 'b.score'} AS best_score,
       CASE WHEN b.pos IS NOT NULL THEN array_to_string(list_slice(f.ls, greatest(b.pos - {fo.LINES_ABOVE}, 0) + 1,
            greatest(b.pos - {fo.LINES_ABOVE}, 0) + {fo.CHUNK_MAX_LINES}), chr(10)) END AS chunk, len(f.ls) AS n_lines
FROM (SELECT filing_id, {S.clean_lines('text')} AS ls FROM ({src})) f LEFT JOIN (SELECT filing_id, pos, score FROM (
        SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY score DESC, pos) AS rn FROM ({scored})) WHERE rn = 1
        AND score > 0 AND score >= {fo.SIMILARITY_THRESHOLD}) b USING (filing_id)"""


def best_chunk_lev(src: str = PAGES_TEXT) -> str:
    scored = f"SELECT filing_id, pos, {lev_ratio('line')} AS score FROM ({filing_lines_sql(src)})"
    return f"SELECT filing_id, best_pos, best_score, chunk FROM ({chunks(src, scored)})"


def best_chunk(src: str = PAGES_TEXT) -> str:
    return f"SELECT filing_id, best_pos, best_score, chunk FROM ({chunks(src, line_header_score(src))})"


def filing_scan() -> str:
    """Pages as the text files that hold them: a line break at the end."""
    html = "coalesce(html, '') || chr(10)"
    return (f"SELECT filing_id, length(html) AS n_chars, len(string_split(text, chr(10))) AS n_nodes FROM ("
            f"SELECT CAST(page_id AS VARCHAR) AS filing_id, {html} AS html, {html_to_text('(' + html + ')')} AS text FROM pages)")


def fields(src: str) -> str:
    step = (f"CASE WHEN acc.cik <> 'N/A' AND acc.date <> 'N/A' THEN acc ELSE "
            f"{{'cik': CASE WHEN contains(l, 'CIK') THEN regexp_replace(l, '[^\\p{{Nd}}]', '', 'g') ELSE acc.cik END, "
            f"'date': CASE WHEN contains(l, 'Date') OR contains(l, 'Filed') THEN {last_ws_token('l')} ELSE acc.date END}} END")
    fold = (f"list_reduce(regexp_split_to_array(text, {q(S.LINE_BREAK)}), lambda acc, l: {step}, "
            f"{{'cik': 'N/A', 'date': 'N/A'}})")
    return f"SELECT filing_id, r.cik AS cik, r.date AS filing_date FROM (SELECT filing_id, {fold} AS r FROM ({src}))"


def filing_stream() -> str:
    bad = "CAST(filing_id AS BIGINT) % 50 = 7"
    prompt = f"{q(fo.PROMPT_V2_HEAD)} || chunk || {q(fo.PROMPT_V2_TAIL)}"
    page = "SELECT CAST(page_id AS VARCHAR) AS filing_id, text FROM (SELECT page_id, " + html_to_text("coalesce(html, '')") + " AS text FROM pages)"
    return f"""
SELECT filing_id, CASE WHEN {bad} THEN 'dead_letter' ELSE 'result' END AS outcome,
  CASE WHEN {bad} THEN 'unreadable' WHEN best_pos IS NULL THEN 'no_section' ELSE 'prompted' END AS status,
  CASE WHEN {bad} THEN 'not UTF-8' END AS reason, CASE WHEN NOT {bad} THEN cik END AS cik, CASE WHEN NOT {bad} THEN filing_date END AS filing_date,
  CASE WHEN NOT {bad} THEN n_lines END AS n_lines, CASE WHEN NOT {bad} THEN best_pos END AS best_pos,
  CASE WHEN NOT {bad} THEN best_score END AS best_score, CASE WHEN NOT {bad} THEN {prompt} END AS prompt
FROM ({chunks(page, line_header_score(page))}) JOIN ({fields(page)}) USING (filing_id)"""


def truncate_tokens(x: str, n: int) -> str:
    pieces = f"regexp_extract_all({x}, {q(S.NONWS + '+' + S.WS + '*')})"
    lead = f"regexp_extract({x}, {q(chr(92) + 'A(' + S.WS + '*)')}, 1)"
    kept = f"array_to_string(list_slice({pieces}, 1, {n}), '')"
    return f"({lead} || regexp_replace({kept}, {q(S.WS + '+' + chr(92) + 'z')}, ''))"


def shorten(x: str, width: int = 800, placeholder: str = " [...]") -> str:
    c = S.collapse_ws(x)
    keep = width - len(placeholder)
    head = f"regexp_extract({c}, {q('^(.{0,' + str(keep) + '}) ')}, 1)"
    return (f"CASE WHEN length({c}) <= {width} THEN {c} WHEN {head} = '' THEN {q(placeholder.lstrip())} "
            f"ELSE {head} || {q(placeholder)} END")


# ------------------------------------------------------------- tables ------

def pipe_fields(line: str) -> str:
    parts = f"string_split({line}, '|')"
    return f"list_transform({parts}[2:len({parts}) - 1], lambda f: {S.strip('f')})"


def parse_pipe(src: str) -> str:
    cut = (f"CASE WHEN strpos(answer, '<END_OF_TABLE>') > 0 THEN "
           f"substr(answer, 1, strpos(answer, '<END_OF_TABLE>') - 1) ELSE answer END")
    return f"""
WITH a AS (SELECT filing_id, answer, list_filter(string_split({cut}, chr(10)),
                  lambda l: contains(l, '|') AND NOT contains(l, '---')) AS ls FROM ({src})),
p AS (SELECT filing_id, answer, ls, list_transform(ls, lambda l: {pipe_fields('l')}) AS fs FROM a),
h AS (SELECT filing_id, answer, ls, fs, fs[1] AS header, fs[2:] AS rows FROM p)
SELECT filing_id, header, rows,
  CASE WHEN {S.strip('answer')} = '' THEN 'empty_answer'
       WHEN len(ls) = 0 THEN 'no_table'
       WHEN len(rows) = 0 THEN 'header_only'
       WHEN len(list_filter(rows, lambda r: len(r) > len(header))) > 0 THEN 'parse_failed'
       ELSE 'ok' END AS status
FROM h"""


def answers_sql() -> str:
    return f"SELECT filing_id, {answer_text('response')} AS answer FROM ({derived_responses()})"


def dedupe(names: str, sep: str, first: int) -> str:
    cnt = f"len(list_filter({names}[1:i - 1], lambda m: m = n))"
    return (f"list_transform({names}, lambda n, i: CASE WHEN {cnt} > 0 THEN n || '{sep}' || "
            f"CAST({cnt} + {first - 1} AS VARCHAR) ELSE n END)")


def pipe_table_cells() -> str:
    return f"""
WITH p AS (SELECT filing_id, {dedupe('header', '_', 2)} AS header, rows FROM ({parse_pipe(answers_sql())}) WHERE status = 'ok'),
r AS (SELECT filing_id, header, unnest(rows) AS row, generate_subscripts(rows, 1) AS rn FROM p),
c AS (SELECT filing_id, header, rn, unnest(row) AS value, generate_subscripts(row, 1) AS cn FROM (
        SELECT filing_id, header, rn, row || list_transform(range(greatest(len(header) - len(row), 0)), lambda z: 'N/A') AS row FROM r))
SELECT filing_id, 1 AS table_no, CAST(rn - 1 AS BIGINT) AS row_no, CAST(cn - 1 AS BIGINT) AS col_no,
       header[cn] AS col_name, value FROM c"""


def extraction_status() -> str:
    return f"SELECT filing_id, status FROM ({parse_pipe(answers_sql())})"


def tables_with_provenance() -> str:
    """Cells of the pipe tables with two more in each row, straight from the filings' fields."""
    return f"""
WITH c AS ({pipe_table_cells()}), f AS ({filing_fields()}),
w AS (SELECT filing_id, table_no, row_no, max(col_no) AS last FROM c GROUP BY ALL)
SELECT filing_id, table_no, row_no, col_no, col_name, value FROM c
UNION ALL SELECT w.filing_id, table_no, row_no, last + 1, 'CIK', cik FROM w LEFT JOIN f ON w.filing_id = f.filing_id
UNION ALL SELECT w.filing_id, table_no, row_no, last + 2, 'Filing Date', filing_date FROM w LEFT JOIN f ON w.filing_id = f.filing_id"""


def combine_tables(columns: list[str]) -> str:
    sel = ", ".join(f"max(value) FILTER (WHERE col_name = {q(c)}) AS \"{c}\"" for c in columns)
    names = ", ".join(q(c) for c in columns)
    other = ("'{' || coalesce(string_agg('\"' || col_name || '\":\"' || value || '\"', ',' ORDER BY col_no) "
             f"FILTER (WHERE col_name NOT IN ({names})), '') || '}}'")
    return (f"SELECT filing_id, table_no, row_no, {sel}, {other} AS other FROM ({tables_with_provenance()}) "
            "GROUP BY filing_id, table_no, row_no")


def csv_edge_cells() -> str:
    """The cells that the rendered text was made from."""
    key = "CAST(o_orderkey AS VARCHAR)"
    long = "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN repeat('x', 50000) ELSE 'x' END"
    cells = [(1, 0, "key", "NULL"), (1, 0, "name", key), (1, 0, "note", "'b'"),
             (1, 1, "key", key), (1, 1, "name", "NULL"), (1, 1, "note", "NULL"),
             (1, 2, "key", "'1'"), (1, 2, "name", f"'p \"' || {key} || '\"' || chr(10) || 'q, r'"), (1, 2, "note", long),
             (2, 0, "a", key), (2, 0, "b", "'3'"), (2, 1, "a", "NULL"), (2, 1, "b", "NULL")]
    cols = {1: ["key", "name", "note"], 2: ["a", "b"]}
    return " UNION ALL ".join(
        f"SELECT {key} AS filing_id, CAST({t} AS BIGINT) AS table_no, CAST({r} AS BIGINT) AS row_no, "
        f"CAST({cols[t].index(c)} AS BIGINT) AS col_no, {q(c)} AS col_name, CAST({v} AS VARCHAR) AS value FROM orders"
        for t, r, c, v in cells)


def csv_edge_status() -> str:
    return " UNION ALL ".join(f"SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, CAST({t} AS BIGINT) AS table_no, {q(s)} AS status FROM orders"
                              for t, s in ((1, "ok"), (2, "ok"), (3, "unparsable"), (4, "unparsable")))


DECODE_REFERENCES = ("SELECT c_custkey, '&lt;b&gt; é' || chr(160) || ' x© ' || c_name || ' — y 😀 ¬it; & &am & ½ ' || chr(65533) || "
                     "chr(65533) || ' &unknown; &amp; ♥' AS text FROM customer")


CSV_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def _csv_base() -> str:
    fields = (f"list_transform(regexp_extract_all(l, {q(CSV_FIELD)}, 1), lambda f: CASE WHEN starts_with(f, '\"') "
              f"AND ends_with(f, '\"') AND length(f) >= 2 THEN replace(substr(f, 2, length(f) - 2), '\"\"', '\"') ELSE f END)")
    return f"""
WITH pc AS (SELECT filing_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS table_no FROM (
        SELECT filing_id, string_split(answer, {q(TABLE_SEPARATOR)}) AS ps FROM ({derived_csv_answers()}))),
t AS (SELECT filing_id, table_no, list_filter(regexp_split_to_array({S.strip('piece')}, '\\r?\\n'),
             lambda l: {S.strip('l')} <> '') AS ls FROM pc),
f AS (SELECT filing_id, table_no, ls, list_transform(ls, lambda l: {fields}) AS fs FROM t),
e AS (SELECT *, greatest(coalesce(len(fs[2]), 0) - len(fs[1]), 0) AS extra FROM f),
g AS (SELECT filing_id, table_no, fs[1] AS header, list_transform(fs[2:], lambda r: r[extra + 1:]) AS rows,
             len(ls) > 0 AND len(list_filter(fs[2:], lambda r: len(r) > len(fs[1]) + extra)) = 0 AS ok FROM e),
ok AS (SELECT filing_id, CAST(table_no AS BIGINT) AS table_no, {dedupe('header', '.', 1)} AS header, rows FROM g WHERE ok),
{{tail}}
"""


def csv_tables() -> str:
    na = "(" + ", ".join(q(t) for t in NA_TOKENS) + ")"
    tail = f"""r AS (SELECT filing_id, table_no, header, unnest(rows) AS row, generate_subscripts(rows, 1) AS rn FROM ok),
c AS (SELECT filing_id, table_no, header, rn, row, unnest(range(1, len(header) + 1)) AS cn FROM r)
SELECT filing_id, table_no, CAST(rn - 1 AS BIGINT) AS row_no, CAST(cn - 1 AS BIGINT) AS col_no, header[cn] AS col_name,
       CASE WHEN row[cn] IN {na} THEN NULL ELSE row[cn] END AS value FROM c"""
    return _csv_base().replace("{tail}", tail)


def csv_ok_tables() -> str:
    return _csv_base().replace("{tail}", "x AS (SELECT 1)\nSELECT filing_id, table_no FROM ok")


def html_table_cells() -> str:
    """Four cells for each line item, straight from the table."""
    row = (f"{_d('l_shipdate')} || '</td><td>&nbsp;</td><td>&nbsp;</td><td>' || {_money('l_quantity')} || '</td><td>&nbsp;</td><td>&nbsp;</td>"
           f"<td>$</td><td>' || {_money('l_extendedprice')} || '</td><td>&nbsp;</td><td>&nbsp;</td><td>&nbsp;</td><td>' || CAST(l_linenumber AS VARCHAR)")
    cells = [(0, "Period", _d("l_shipdate")), (3, "Total Number of Shares Purchased", _money("l_quantity")),
             (6, "Average Price Paid per Share", f"'$ ' || {_money('l_extendedprice')}"),
             (11, "Total Number of Shares Purchased as Part of Programs", "CAST(l_linenumber AS VARCHAR)")]
    urgent = "o_orderpriority = '1-URGENT'"
    lines = (f"SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {row}) - 1 + CASE WHEN {urgent} THEN 1 ELSE 0 END AS row_no "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    # the row without numbers that urgent orders open with
    first = [(0, "Opening"), (3, "N/A"), (6, "$ —"), (11, "-")]
    opening = [f"SELECT CAST(o_orderkey AS VARCHAR), 1, 0, {c}, {q(cells[k][1])}, {q(v)} FROM orders WHERE {urgent}" for k, (c, v) in enumerate(first)]
    return f"WITH l AS ({lines}) " + " UNION ALL ".join([
        f"SELECT CAST(l_orderkey AS VARCHAR) AS filing_id, CAST(1 AS BIGINT) AS table_no, row_no, CAST({c} AS BIGINT) AS col_no, "
        f"{q(n)} AS col_name, {v} AS value FROM l" for c, n, v in cells] + opening)


def _header_scores(headers: str) -> str:
    """CTEs ending in ``pair (line, canonical, k, score)`` for distinct ``headers (line)``, by the ratio's recursion."""
    names = ", ".join(f"({k}, {q(n)})" for k, n in enumerate(fo.CANONICAL_COLUMNS))
    # the recursion's line carries both names
    both = "line || chr(0) || canonical"
    base = _longest_match(f"SELECT {both} AS line, lower(line) AS a, lower(canonical) AS b FROM (SELECT DISTINCT line FROM ({headers})) CROSS JOIN canon")
    sides = ("SELECT line, unnest([substr(a, 1, i - 1), substr(a, i + k)]) AS a, unnest([substr(b, 1, j - 1), substr(b, j + k)]) AS b "
             "FROM block WHERE k > 0")
    more = _longest_match(f"SELECT * FROM ({sides}) WHERE a <> '' AND b <> ''")
    return (f"canon (k, canonical) AS (VALUES {names}), block AS ({base} UNION ALL {more}), "
            f"total AS (SELECT line AS pair_key, sum(k) AS m FROM block GROUP BY line), "
            f"pair AS (SELECT h.line, canonical, canon.k, 2.0 * m / (length(lower(h.line)) + length(canonical)) AS score "
            f"FROM (SELECT DISTINCT line FROM ({headers})) h CROSS JOIN canon JOIN total ON pair_key = h.line || chr(0) || canonical)")


def canonical_columns(threshold: float = 0.5) -> str:
    return (f"WITH RECURSIVE {_header_scores('SELECT col_name AS line FROM (' + html_table_cells() + ')')}, "
            "best AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY score DESC, k) AS rn FROM pair) "
            f"SELECT line AS col_name, CASE WHEN score >= {threshold} THEN canonical END AS canonical, CAST(score AS DOUBLE) AS score FROM best WHERE rn = 1")


def canonical_cells(threshold: float = 0.5) -> str:
    """The tables' four headers against all ways to give them different names: the best sum, then the least names in turn."""
    heads = ["Period", "Total Number of Shares Purchased", "Average Price Paid per Share", "Total Number of Shares Purchased as Part of Programs"]
    n = len(fo.CANONICAL_COLUMNS)
    way = ", ".join(f"w{i} AS (SELECT k, round(score * 1e9) AS s FROM pair WHERE line = {q(h)} AND score >= {threshold} UNION ALL SELECT {n}, 0)"
                    for i, h in enumerate(heads))
    differ = " AND ".join(f"(w{i}.k <> w{j}.k OR w{i}.k = {n})" for j in range(4) for i in range(j))
    total = " + ".join(f"w{i}.s" for i in range(4))
    ks = ", ".join(f"w{i}.k AS k{i}" for i in range(4))
    named = " UNION ALL ".join(f"SELECT {q(h)} AS header, k{i} AS k FROM best" for i, h in enumerate(heads))
    return (f"WITH RECURSIVE {_header_scores(' UNION ALL '.join(f'SELECT {q(h)} AS line' for h in heads))}, {way}, "
            f"best AS (SELECT {ks} FROM w0, w1, w2, w3 WHERE {differ} ORDER BY {total} DESC, k0, k1, k2, k3 LIMIT 1), "
            f"name AS (SELECT header, coalesce(canonical, header) AS col_name FROM ({named}) LEFT JOIN canon USING (k)) "
            f"SELECT filing_id, table_no, row_no, col_no, header, name.col_name, value FROM ({html_table_cells()}) c JOIN name ON c.col_name = header")


def filing_outcomes(max_bytes: int) -> str:
    """Every outcome from the pages' own rules, the answers by key."""
    page = ("SELECT page_id, CAST(page_id AS VARCHAR) AS filing_id, strlen(coalesce(html, '')) AS n_bytes, "
            + html_to_text("(CASE WHEN page_id % 50 = 11 THEN ' ' || chr(10) ELSE coalesce(html, '') END)") + " AS text FROM pages")
    dead = (f"CASE WHEN page_id % 50 <> 11 AND n_bytes + CASE WHEN page_id % 50 = 7 THEN 2 ELSE 0 END > {max_bytes} THEN 'too_large' "
            "WHEN page_id % 50 = 7 THEN 'unreadable' WHEN best_pos IS NULL THEN 'no_section' END")
    joined = f"""
SELECT page.filing_id, page_id, {dead} AS before, n_bytes, cik, filing_date,
  CASE WHEN CAST(page.filing_id AS BIGINT) % 40 = 3 AND a.filing_id IS NOT NULL THEN 'timeout' END AS failed, coalesce(a.answer, '') AS answer
FROM ({page}) page JOIN ({chunks(page, line_header_score(page))}) c USING (filing_id) JOIN ({fields(page)}) f USING (filing_id)
LEFT JOIN ({answers_sql()}) a USING (filing_id)"""
    return f"""
WITH d AS MATERIALIZED ({joined}), p AS (SELECT d.*, header, rows, status AS parsed FROM d JOIN ({parse_pipe("SELECT filing_id, answer FROM d")}) USING (filing_id)),
s AS (SELECT *, coalesce(before, CASE WHEN failed IS NOT NULL THEN 'model_error' END, parsed) AS status, before IN ('too_large', 'unreadable') AS dead FROM p)
SELECT filing_id, status, CASE before WHEN 'too_large' THEN CAST(n_bytes + CASE WHEN page_id % 50 = 7 THEN 2 ELSE 0 END AS VARCHAR) || ' bytes'
    WHEN 'unreadable' THEN 'not UTF-8' WHEN 'no_section' THEN NULL ELSE failed END AS reason,
  CASE WHEN dead THEN NULL ELSE cik END AS cik, CASE WHEN dead THEN NULL ELSE filing_date END AS filing_date,
  CASE WHEN status = 'ok' THEN array_to_string({dedupe('header', '_', 2)} || ['CIK', 'Filing Date'], '|') END AS header,
  CASE WHEN status = 'ok' THEN array_to_string(list_transform(rows, lambda r: array_to_string(
    r || list_transform(range(greatest(len(header) - len(r), 0)), lambda z: 'N/A') || [cik, filing_date], '|')), chr(10)) END AS rows
FROM s"""


def _na(x: str) -> str:
    return f"CASE WHEN {x} IN (" + ", ".join(q(t) for t in NA_TOKENS) + f") THEN NULL ELSE {x} END"


def parsed_files() -> str:
    """The cells that went into the files: those of the pipe tables, missing values null."""
    return (f"SELECT filing_id || '_parsed.csv' AS file_name, row_no, col_no, col_name, {_na('value')} AS value "
            f"FROM ({tables_with_provenance()})")


def v1_files() -> str:
    """The cells of the CSV tables with two more in each row, under the tables' names; shared names have the filing in them."""
    return f"""
WITH c AS ({csv_tables()}), f AS ({filing_fields()}),
w AS (SELECT filing_id, table_no, row_no, max(col_no) AS last FROM c GROUP BY ALL),
every AS (SELECT * FROM c
  UNION ALL SELECT w.filing_id, table_no, row_no, last + 1, 'CIK', {_na('cik')} FROM w JOIN f ON w.filing_id = f.filing_id
  UNION ALL SELECT w.filing_id, table_no, row_no, last + 2, 'filing_date', {_na('filing_date')} FROM w JOIN f ON w.filing_id = f.filing_id),
named AS (SELECT DISTINCT t.filing_id, table_no, cik || '_' || filing_date || '_item2_table' || CAST(table_no AS VARCHAR) AS base
  FROM ({csv_ok_tables()}) t JOIN f ON t.filing_id = f.filing_id),
file AS (SELECT *, base || CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN '_' || filing_id ELSE '' END || '.csv' AS file_name FROM named)
SELECT file_name, row_no, col_no, col_name, value FROM every JOIN file USING (filing_id, table_no)"""


def extraction_run(columns: list[str]) -> str:
    """The combined table: rows of every page that could be read, has a chunk and got a table for an answer."""
    page = ("SELECT CAST(page_id AS VARCHAR) AS filing_id, " + html_to_text("coalesce(html, '')") + " AS text FROM pages WHERE page_id % 50 <> 7")
    src = f"""SELECT a.filing_id, a.answer FROM ({answers_sql()}) a JOIN ({chunks(page, line_header_score(page))}) c USING (filing_id)
WHERE best_pos IS NOT NULL AND CAST(a.filing_id AS BIGINT) % 40 <> 3"""
    own = "(" + ", ".join(q(c) for c in columns) + ")"
    pick = ", ".join(f"nullif(row[list_position(header, {q(c)})], '') AS \"{c}\"" for c in columns)
    rest = (f"'{{' || array_to_string(list_transform(list_filter(range(1, len(header) + 1), lambda i: header[i] NOT IN {own}), "
            "lambda i: '\"' || header[i] || '\":\"' || row[i] || '\"'), ',') || '}'")
    return f"""
WITH p AS (SELECT filing_id, {dedupe('header', '_', 2)} || ['CIK', 'Filing Date'] AS header, rows, cik, filing_date, len(header) AS n
  FROM ({parse_pipe(src)}) JOIN ({fields(page)}) USING (filing_id) WHERE status = 'ok'),
r AS (SELECT filing_id, header, cik, filing_date, n, unnest(rows) AS row, generate_subscripts(rows, 1) AS rn FROM p),
f AS (SELECT filing_id, header, rn, row || list_transform(range(greatest(n - len(row), 0)), lambda z: 'N/A') || [cik, filing_date] AS row FROM r)
SELECT filing_id, CAST(rn - 1 AS BIGINT) AS row_no, {pick}, {rest} AS other FROM f"""
