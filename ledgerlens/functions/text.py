"""Text rules as Spark column expressions.

Python's string rules (``str.strip``, ``str.splitlines``, ``str.split``,
``re``'s ``\\s``/``$``) differ from Java's; every helper here states the
Python rule it reproduces so results match the filing extractor exactly.
All helpers are built-in expressions (JVM side, codegen friendly); none
crosses into Python.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Python's whitespace set (str.isspace / str.strip / str.split): 29 characters.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same set as a regex class; the \x{..} form is read by Java and RE2 alike.
WS_CLASS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# str.splitlines separators: \r\n, \n, \r, \v, \f, FS, GS, RS, NEL, LS, PS.
LINE_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# --------------------------------------------------------------------------

assert len(WS_CHARS) == 29


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_once(df, **cols):
    """Add columns computed exactly once per row.

    Higher-order functions re-evaluate an outer expression each time a
    lambda mentions it; emitting the values through a generator turns them
    into plain attributes that later lambdas can read for free.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in cols.items()]))))


def py_strip(c) -> Column:
    """Python ``s.strip()``: remove the 29 whitespace characters at both ends."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Python ``' '.join(s.split())``."""
    return F.regexp_replace(py_strip(c), WS_CLASS + "+", " ")


def split_lines(c) -> Column:
    """Python ``s.splitlines()`` (without dropping a trailing empty piece;
    callers that strip and drop blanks are unaffected)."""
    return F.split(col_(c), LINE_BREAK)


def clean_lines(c) -> Column:
    """``[l.strip() for l in s.splitlines() if l.strip()]`` as array<string>."""
    stripped = F.transform(split_lines(c), lambda l: py_strip(l))
    return F.filter(stripped, lambda l: l != F.lit(""))


def last_ws_token(c) -> Column:
    """``s.split()[-1]`` ('' when s has no token)."""
    return F.regexp_extract(col_(c), r"([^\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+)" + WS_CLASS + r"*\z", 1)


def ws_tokens(c) -> Column:
    """``s.split()`` as array<string> (empty array for blank text)."""
    s = py_strip(c)
    return F.when(s == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(s, WS_CLASS + "+"))


# ---------------------------------------------------------------- HTML -----

# --- fixed values -----------------------------------------------------------
# Windows-1252 reading of numeric references 128..159 (HTML5 rule).
CP1252_C1 = [0x20AC, 0x81, 0x201A, 0x0192, 0x201E, 0x2026, 0x2020, 0x2021,
             0x02C6, 0x2030, 0x0160, 0x2039, 0x0152, 0x8D, 0x017D, 0x8F,
             0x90, 0x2018, 0x2019, 0x201C, 0x201D, 0x2022, 0x2013, 0x2014,
             0x02DC, 0x2122, 0x0161, 0x203A, 0x0153, 0x9D, 0x017E, 0x0178]
# --------------------------------------------------------------------------

# An HTML tag: '<' or '</' followed by a letter; quoted attribute values may
# contain '>' but no '<'. Where quotes don't pair up, the tag ends at the first
# '>'. Possessive throughout, so time is linear and no stack is used.
TAG = r"""</?[A-Za-z](?:(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|[^<>]*+>)"""
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
DECL = r"<![^>]*>|<\?[^>]*>"
# '<' stands before the branches, so that text between tags is passed at the speed of a search for it.
NON_TEXT = (r"(?is)<(?:!--.*?(?:-->|\z)"
            + "".join(rf"|{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "template"))
            + r"|!(?!\[CDATA\[)[^>]*>|\?[^>]*>)")
CDATA = r"(?s)<!\[CDATA\[(.*?)(?:\]\]>|\z)"


def _codepoint_char(n: Column) -> Column:
    """Character for a numeric character reference (HTML5 decoding rules)."""
    cp1252 = F.array(*[F.lit(x) for x in CP1252_C1])
    cp = (F.when((n >= 128) & (n <= 159), F.element_at(cp1252, (n - 127).cast("int")))
          .when((n == 0) | ((n >= 0xD800) & (n <= 0xDFFF)) | (n > 0x10FFFF), F.lit(0xFFFD))
          .otherwise(n))
    invalid = (((cp >= 1) & (cp <= 8)) | (cp == 0x0B) | ((cp >= 0x0E) & (cp <= 0x1F))
               | ((cp >= 0x7F) & (cp <= 0x9F) & (n >= 160))
               | ((cp >= 0xFDD0) & (cp <= 0xFDEF)) | ((cp % 65536) >= 0xFFFE))
    ch = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return F.when(invalid, F.lit("")).otherwise(ch)


# A character reference; a name or number without ';' is one too.
REFERENCE = "&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;?)"
# Longest name that is read without ';', as a prefix of what follows '&'.
_LONGEST_OPEN_NAME = max(len(n) for n in html5 if not n.endswith(";"))


def _name_map(names: dict[str, str]) -> Column:
    """Map literal of the standard library's table (folded to one constant)."""
    pairs = "\ue001".join(f"{n}\ue000{c}" for n, c in names.items())
    return F.str_to_map(F.lit(pairs), F.lit("\ue001"), F.lit("\ue000"))


def _reference_char(r: Column) -> Column:
    """Text of one character reference; an unknown one stays as it is."""
    dec = F.regexp_extract(r, "^&#0*+([0-9]*)", 1)
    hexa = F.regexp_extract(r, "^&#[xX]0*+([0-9a-fA-F]*)", 1)
    number = (F.when(r.rlike("^&#[xX]"), F.when(F.length(hexa) > 6, F.lit(1 << 22)).otherwise(
                  F.coalesce(F.conv(F.concat(F.lit("0"), hexa), 16, 10).cast("long"), F.lit(0))))
              .otherwise(F.when(F.length(dec) > 7, F.lit(1 << 22)).otherwise(
                  F.concat(F.lit("0"), dec).cast("long"))))
    name = F.substring(r, 2, 64)
    common = F.when(name == "amp;", "&").when(name == "nbsp;", "\u00a0").when(name == "lt;", "<").when(name == "gt;", ">").when(name == "quot;", '"')
    open_names = _name_map({n: c for n, c in html5.items() if not n.endswith(";")})
    found = F.coalesce(common, F.try_element_at(_name_map({n: c for n, c in html5.items() if n.endswith(";")}), name),
                       *[F.concat(F.try_element_at(open_names, F.substring(r, 2, k)), F.substring(r, k + 2, 1 << 20))
                         for k in range(_LONGEST_OPEN_NAME, 1, -1)], r)
    return F.when(F.substring(r, 2, 1) == "#", _codepoint_char(number)).otherwise(found)


def decode_entities(c, keep_markup: bool = False) -> Column:
    """Decode character references (the HTML5 names and numbers), in one pass from left to right.

    ``keep_markup`` leaves the references of ``& < >`` encoded, so a whole
    table can be decoded once before its tags are split off (the remaining
    three are decoded per cell afterwards).
    """
    s = col_(c)

    def char(r):
        ch = _reference_char(r)
        return F.when(F.substring(ch, 1, 1).isin("&", "<", ">"), r).otherwise(ch) if keep_markup else ch

    found = F.transform(F.regexp_extract_all(s, F.lit(REFERENCE), F.lit(0)), char)
    pieces = F.split(s, REFERENCE, -1)
    both = F.zip_with(pieces, found, lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    return F.when(F.instr(s, "&") > 0, F.array_join(both, "")).otherwise(s)


def html_text_nodes(c) -> Column:
    """Visible text nodes of an HTML document, in order (array<string>).

    Comments, declarations (doctype), processing instructions and the
    contents of script/style/template are not text; every other run of
    characters between tags is one node (entities still encoded), that of a
    CDATA section too.
    """
    # comments, script/style/template bodies and declarations: one pass
    s = F.regexp_replace(col_(c), NON_TEXT, "")
    # a CDATA section is a node of its own
    s = F.when(F.instr(s, "<![CDATA[") > 0, F.regexp_replace(s, CDATA, "<b>$1<b>")).otherwise(s)
    return F.filter(F.split(s, TAG), lambda x: x != F.lit(""))


def html_to_text(c) -> Column:
    """``get_text(separator="\\n")`` of the document: nodes joined by newline.

    Entities are decoded once on the joined text: a reference never spans a
    node boundary, so this equals decoding node by node.
    """
    return decode_entities(F.array_join(html_text_nodes(c), "\n"))


def shorten(c, width: int = 800, placeholder: str = " [...]") -> Column:
    """``textwrap.shorten(s, width, placeholder)`` (word boundaries at spaces)."""
    s = collapse_ws(c)
    keep = width - len(placeholder)
    head = F.regexp_extract(s, rf"^(.{{0,{keep}}}) ", 1)
    cut = F.when(head == F.lit(""), F.lit(placeholder.lstrip())).otherwise(F.concat(head, F.lit(placeholder)))
    return F.when(F.length(s) <= width, s).otherwise(cut)
