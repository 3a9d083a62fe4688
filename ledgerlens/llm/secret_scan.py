"""Secret scan by corpus-wide ownership frequency (DataFrame functions only).

Candidates are the three base kinds (credential assignments, access key ids,
long hex strings) and ``opaque``: runs of 20 or more base64 characters that mix
upper case, lower case and digits with enough different characters. A value that
many owners hold is a widely copied example; one that a single owner holds, in
one or two repositories, is owner-specific and looks live.

The corpus-wide part is one aggregation: candidate value hashes counted by
distinct (owner, repository), combined on the map side, so a value that a third
of all rows hold leaves each map task as a few rows. The verdicts are joined back
to the candidates by hash from written tables, plain joins that adaptive
execution splits where one value is hot. Texts are read once and never shuffled.

Defined results: a null or empty text has no spans. Rows are answered one for
one, repeated rows included (equal rows have equal answers). Null owners or
repositories count as one owner or repository of the empty name. An empty table
gives an empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import null_safe, written

ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "opaque")

#: A value held by this many owners or more is a copied example.
COPIED_OWNERS = 3
#: An owner-specific value is in at most this many repositories.
LIVE_REPOS = 2
#: An opaque value needs this many different characters.
OPAQUE_DISTINCT = 12


_SPANS = "array<struct<s:int,k:int,e:int,kind:string,m:string>>"
#: Elements that a fold gathers at a time.
CHUNK = 256
#: Greater than any place in a text.
_BEYOND = (1 << 31) - 1


def _once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns that are worked out once a row: lambdas would evaluate them again for each element."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def _matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches, and the lengths of the stretches between them."""
    some = text.rlike(pattern)
    return (F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
            F.when(some, F.transform(F.split(text, pattern, -1), F.length)).otherwise(F.array().cast("array<int>")))


def _chunks(array: Column) -> Column:
    """The array in pieces of ``CHUNK``: folds that gather their results copy no more than a piece at each step."""
    n = F.size(array)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")))
    return F.coalesce(F.transform(starts, lambda k: F.slice(array, k * CHUNK + 1, CHUNK)), F.array())


def _pairs(found: str, gaps: str) -> Column:
    """(match, stretch before it) in chunks."""
    return _chunks(F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("gap"))))


def _spans(chunks: str, kind: str, order: int) -> Column:
    """Array of (start, kind order, end, kind, match) of the matches, in code points.

    Splitting by the pattern gives the stretches between the matches, so a
    match starts after all earlier stretches and matches.
    """
    lengths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["m"])))
    starts = F.transform(lengths, lambda n, k: F.aggregate(F.slice(lengths, 1, k), F.lit(0), lambda a, x: a + x))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["m"])
        one = F.struct(s.alias("s"), F.lit(order).alias("k"), e.alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def walk(c: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast(_SPANS).alias("out"))
        return F.aggregate(c, zero, step, lambda a: a["out"])
    return F.when(F.size(chunks) == 0, F.array().cast(_SPANS)).otherwise(F.flatten(F.zip_with(chunks, starts, walk)))


def _walk_apart(chunks: str, backwards: bool) -> Column:
    """The spans in ``chunks``, sorted from the left or ``backwards`` from the right, without the opaque ones that the base
    spans on their way reach into."""
    base = lambda x: x["k"] <= 2
    own, far, none = ("s", F.least, _BEYOND) if backwards else ("e", F.greatest, 0)
    reach = F.transform(chunks, lambda c: F.aggregate(c, F.lit(none), lambda a, x: F.when(base(x), far(a, x[own])).otherwise(a)))
    edges = F.transform(reach, lambda r, k: F.aggregate(F.slice(reach, 1, k), F.lit(none), lambda a, x: far(a, x)))

    def step(acc: Column, x: Column) -> Column:
        stays = base(x) | ((acc["edge"] >= x["e"]) if backwards else (x["s"] >= acc["edge"]))
        return F.struct(F.when(base(x), far(acc["edge"], x[own])).otherwise(acc["edge"]).alias("edge"),
                        F.when(stays, F.concat(acc["out"], F.array(x))).otherwise(acc["out"]).alias("out"))

    def walk(c: Column, edge: Column) -> Column:
        zero = F.struct(edge.alias("edge"), F.array().cast(_SPANS).alias("out"))
        return F.aggregate(c, zero, step, lambda a: a["out"])
    return F.when(F.size(chunks) == 0, F.array().cast(_SPANS)).otherwise(F.flatten(F.zip_with(chunks, edges, walk)))


def _value(x: Column) -> Column:
    """The secret of a match: of an assignment what is assigned, else the match."""
    return F.when(x["kind"] == "assign", F.regexp_extract(x["m"], ASSIGN, 2)).otherwise(x["m"])


def _looks_live(m: Column) -> Column:
    distinct = F.size(F.array_distinct(F.split(m, "")))
    return m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]") & (distinct >= OPAQUE_DISTINCT)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column) -> DataFrame:
    """Per row: id, owner, repo and ``cands``, the candidate spans with their value hashes."""
    text = null_safe(F.col(f"`{text_col}`"))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"),
                       null_safe(owner).alias("owner"), null_safe(repo).alias("repo"))
    found = {}
    for name, pattern in zip("acho", (ASSIGN, ACCESS, HEX, OPAQUE), strict=True):
        found[f"{name}_m"], found[f"{name}_g"] = _matches(F.col("text"), pattern)
    parts = _once(base, **found).drop("text")
    parts = _once(parts, **{f"{name}_p": _pairs(f"{name}_m", f"{name}_g") for name in "acho"})
    parts = _once(parts, **{name: _spans(f"{name}_p", kind, k) for k, (name, kind) in enumerate(zip("acho", KINDS, strict=True))})
    kept = F.concat(F.filter("a", lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 8), "c", "h",
                    F.filter("o", lambda x: _looks_live(x["m"])))
    # an opaque run inside a base span is the same secret
    parts = _once(parts.select("id", "owner", "repo", "a", "c", "h", "o"), every=F.array_sort(kept))
    parts = _once(parts, lot=_chunks(F.col("every")))
    parts = _once(parts.select("id", "owner", "repo", "lot"), clear=F.reverse(_walk_apart("lot", False)))
    parts = _once(parts, lot2=_chunks(F.col("clear")))
    parts = _once(parts.select("id", "owner", "repo", "lot2"), apart=F.reverse(_walk_apart("lot2", True)))
    with_hash = F.transform("apart", lambda x: F.struct(
        x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind"),
        F.sha2(_value(x), 256).alias("value")))
    return parts.select("id", "owner", "repo", with_hash.alias("cands"))


def ownership(cands: DataFrame) -> DataFrame:
    """Per candidate value: documents, distinct repositories and owners, and its verdict."""
    each = cands.select("owner", "repo", F.explode("cands").alias("x")).select(
        "owner", "repo", F.col("x.value").alias("value"))
    by_repo = each.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("uses"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("uses").alias("uses"))
    freq = by_owner.groupBy("value").agg(F.sum("uses").alias("n_uses"), F.sum("repos").alias("n_repos"),
                                         F.count(F.lit(1)).alias("n_owners"))
    verdict = (F.when(F.col("n_owners") >= COPIED_OWNERS, "copied")
               .when((F.col("n_owners") == 1) & (F.col("n_repos") <= LIVE_REPOS), "live").otherwise("shared"))
    return freq.withColumn("verdict", verdict)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """(id, spans) per row of ``docs``; a span is (s, k, e, kind, value, n_uses, n_repos, n_owners, verdict).

    ``owner`` and ``repo`` are columns of ``docs`` (default: the source, and the
    source with the language).
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.col("source"), F.col("lang")) if repo is None else repo
    found = written(candidates(docs, id_col, text_col, owner, repo), "secret-candidates")
    freq = written(ownership(found), "secret-ownership")
    # rows that are equal in all that matters are one row with a count, so the
    # candidates can be put together again by content without a row number
    rows = (found.where(F.size("cands") > 0).groupBy("id", "cands").agg(F.count(F.lit(1)).alias("times")))
    rows = rows.withColumn("row", F.sha2(F.to_json(F.struct("id", "cands")), 256))
    each = rows.select("row", "id", "times", F.explode("cands").alias("x")).withColumn("value", F.col("x.value"))
    judged = written(each, "secret-spans").join(freq, "value")
    spans = judged.groupBy("row", "id", "times").agg(F.array_sort(F.collect_list(F.struct(
        F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"), F.col("x.kind").alias("kind"),
        "value", "n_uses", "n_repos", "n_owners", "verdict"))).alias("spans"))
    again = spans.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("id", "spans")
    kind = spans.schema["spans"].dataType
    without = found.where(F.size("cands") == 0).select("id", F.array().cast(kind).alias("spans"))
    return again.unionByName(without)


def report(scanned: DataFrame) -> DataFrame:
    """The contract columns from ``scan``: base spans always, opaque ones where they are owner-specific."""
    base = F.filter("spans", lambda x: x["k"] <= 2)
    kept = F.filter("spans", lambda x: (x["k"] <= 2) | (x["verdict"] == "live"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    judged = lambda v: F.size(F.filter("spans", lambda x: x["verdict"] == v)).cast("long")
    return scanned.select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(kept).alias("spans"),
        judged("live").alias("n_live"), judged("copied").alias("n_copied"))
