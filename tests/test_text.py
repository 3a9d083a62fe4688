import re
import textwrap

from pyspark.sql import functions as F

from ledgerlens.functions import text as tx
from ledgerlens.operators import filings as fo

NBSP = " "


def _one(spark, col_expr, value):
    return spark.createDataFrame([(value,)], "s string").select(col_expr(F.col("s")).alias("r")).first().r


def test_strip_and_splitlines_match_python(spark):
    samples = ["  a b \t", " x　", "a\x1cb\x1dc\x1ed\x85e f g\r\nh\ri\x0bj\x0ck",
               "\n\n  \n", "", "x​y"]
    for s in samples:
        assert _one(spark, tx.py_strip, s) == s.strip()
        got = _one(spark, tx.clean_lines, s)
        assert got == [l.strip() for l in s.splitlines() if l.strip()], repr(s)
        assert _one(spark, tx.collapse_ws, s) == " ".join(s.split())


def test_filing_fields_golden(spark):
    cases = [("CIK: 1\nCIK: 2\nFiled on 2011-04-30\nCIK: 3\nDate x 9", ("2", "2011-04-30")),
             ("no", ("N/A", "N/A")),
             ("Date: N/A\nCIK 7 8\nFiled 2010", ("78", "2010")),
             ("CIK\nDate q", ("", "q"))]
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(cases)], "filing_id string, text string")
    got = {r.filing_id: (r.cik, r.filing_date) for r in fo.filing_fields(df).collect()}
    for i, (_, want) in enumerate(cases):
        assert got[str(i)] == want


def test_item_section_equals_python_re(spark):
    texts = ["x Part II a Item 2 b Item 3 c", f"PART{NBSP}II item 1 q item 2 z\n", "Part II Item 20 foo",
             "Part II only", "Item 2 first Part II", "Part II Item 2 a Item 2 b Item 9",
             "Part II Item 2 a\r\n", "Part II Item 2 a\n\n", "pre Part II x Part II Item 2 y Item 4 z"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "filing_id string, text string")
    got = {r.filing_id: r.section for r in fo.item_section(df).collect()}
    for i, t in enumerate(texts):
        m = re.search(r"(?i)Part\s+II.*Item\s+2.*?(?=Item\s+\d|$)", t, re.DOTALL)
        assert got[str(i)] == (m.group(0) if m else ""), repr(t)


def test_html_to_text(spark):
    h = ('<!DOCTYPE html><html><head><title>T &amp; Co</title><style>p{x}</style>'
         '<script>var t="</p>";</script></head><body><!-- c --><p>A&nbsp;B &#151; <b>bold</b> '
         'tail &#x2014; &lt;x&gt; &amp;lt;</p><a title="a>b">link</a> 1 < 2</body></html>')
    got = _one(spark, tx.html_to_text, h)
    assert got == "T & Co\nA B — \nbold\n tail — <x> &lt;\nlink\n 1 < 2"


def test_shorten_matches_textwrap(spark):
    texts = ["word " * 300, "a " * 500 + "b" * 10 + " c" * 200, "short text", "x" * 900, "  many   spaces " * 80]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(tx.shorten(F.col("t")).alias("s")).collect()]
    assert got == [textwrap.shorten(t, width=800, placeholder=" [...]") for t in texts]


def test_truncate_tokens_keeps_spacing(spark):
    got = _one(spark, lambda c: fo.truncate_tokens(c, 3), "  a b\n c  d ")
    assert got == "  a b\n c"


def test_prompt_keeps_marker_when_truncated(spark):
    chunk = " ".join(f"w{i}" for i in range(10000))
    p = _one(spark, lambda c: fo.prompt_v2_truncated(c, 4096), chunk)
    assert p.endswith("OUTPUTT:") and len(p.split()) <= 4096


def test_best_chunk_rules(spark):
    hdr = fo.HEADER_REFERENCE
    lines0 = [hdr] + [f"line {i}" for i in range(20)]
    lines3 = ["a", "b", "c", hdr, "d"]
    lines10 = [f"x{i}" for i in range(10)] + [hdr, "tail"]
    two = ["zz", hdr, "mid", hdr]
    none = ["qqqq"]
    docs = {"0": lines0, "3": lines3, "10": lines10, "two": two, "none": none}
    df = spark.createDataFrame([(k, "\n".join(v)) for k, v in docs.items()], "filing_id string, text string")
    for op in (fo.best_chunk, fo.best_chunk_lev):
        got = {r.filing_id: (r.best_pos, r.chunk) for r in op(df).collect()}
        assert got["0"] == (0, "\n".join(lines0))
        assert got["3"] == (3, "\n".join(lines3))
        assert got["10"] == (10, "\n".join(lines10[5:]))
        assert got["two"][0] == 1
    ratio = {r.filing_id: r.best_pos for r in fo.best_chunk(df, threshold=0.99).collect()}
    assert ratio["none"] is None


def test_line_score_udf_equals_difflib(spark):
    from difflib import SequenceMatcher
    lines = ["Item 2. Unregistered sales", "PART II", "", "random words here", fo.HEADER_REFERENCE.lower()]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "filing_id string, pos int, line string")
    got = {r.pos: r.score for r in fo.line_header_score(df).collect()}
    for i, l in enumerate(lines):
        assert abs(got[i] - SequenceMatcher(None, l.lower(), fo.HEADER_REFERENCE.lower()).ratio()) < 1e-12


def test_answer_text(spark):
    vals = ["pre OUTPUTT:  | a |  ", "no marker here ", "OUTPUTT: x OUTPUTT: y", None]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    got = [r.a for r in df.select(fo.answer_text("r").alias("a")).collect()]
    assert got == ["| a |", "no marker here ", "x OUTPUTT: y", ""]


def test_character_references_and_tags(spark):
    import html
    import random
    from html.entities import html5

    from ledgerlens.functions import text as tx
    r = random.Random(1)
    names = list(html5)
    texts = ["&#38;lt;b&#38;gt;", "&eacute;&nbsp x&copy &#151 y&#x1F600;&#99999999999; &notit; &AMP&am & &; &#; &#x; &#0; &#128;", "", "&amp;lt;"]
    texts += ["".join(r.choice(["&", "&" + r.choice(names), "x", ";", f"&#{r.randint(0, 70000)};", f"&#x{r.randint(0, 99999):x}"])
                      for _ in range(12)) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(x.d == html.unescape(x.t) for x in df.select("t", tx.decode_entities("t").alias("d")).collect())
    pages = ['<p title="x>' + "<td width=\"5%\" b='q'>c" * 5000, "a<b title='x>y'>c</b>d<p t='z>don't <i>", "<p>a<![CDATA[b & c]]>d"]
    nodes = [x.n for x in spark.createDataFrame([(t,) for t in pages], "t string").select(tx.html_text_nodes("t").alias("n")).collect()]
    assert nodes == [["c"] * 5000, ["a", "c", "d", "don't "], ["a", "b & c", "d"]]


def test_section_of_any_item(spark):
    from ledgerlens.operators import filings as fo
    t = "x Part II a Item 7 b Item 8 c"
    df = spark.createDataFrame([(t, "7"), (t, "8"), (t, "9"), (t, None), (t, ""), ("Part II Item 7.* z", "7.*")], "text string, item string")
    got = [r.section for r in fo.item_section(df, item_col="item").collect()]
    assert got == ["Part II a Item 7 b ", "Part II a Item 7 b Item 8 c", "", "", "", "Part II Item 7.* z"]
