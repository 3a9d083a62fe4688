"""Quality rules with robust multivariate outliers (DataFrame functions only).

Every text gives base counts and a vector of transformed statistics (word
length and the rates of symbols, capitals, punctuation and line breaks, each
shrunk towards a prior so that short texts do not look extreme, then taken to
logarithms). For each group (language and source; language; all) a minimum-
covariance-determinant estimate is made by concentration steps: from medians and
median deviations, the half-plus (``SUBSET``) of the rows with the least
Mahalanobis distances gives the next mean and covariance, whose determinant
never rises. A row is judged by the finest of its groups with ``MIN_ROWS`` rows
and rejected beyond ``CUTOFF``.

Texts are read once; the steps run over the written vectors, some tens of bytes
a row. A step is one aggregation by (group, distance bucket), combined on the
map side, so a source with a third of all rows is a few hundred rows after it.
The h-quantile is exact to the bucket. Estimates are joined to the rows by
group; the table has a row a group and Spark picks the join by its true size.

Defined results: a null text has no words; texts with fewer than ten words fail
the base rule. Null language or source is the group of the empty name. Rows are
answered one for one. An empty table gives an empty result. Further columns of
the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE, WORD, null_safe, split_by_filter, written

#: Statistics of the vector.
STATS = ("word_len", "symbol", "capital", "punct", "line")
#: Share of a group's rows in the concentrated subset.
SUBSET = 0.75
#: Concentration steps.
STEPS = 3
#: Rows that a group needs for an estimate of its own.
MIN_ROWS = 100
#: Squared Mahalanobis distance beyond which a row is rejected (chi-square of 5: 1e-8 is about 45).
CUTOFF = 60.0
#: Words' worth of prior in each rate, and the least standard deviation of a statistic.
PRIOR_WORDS, FLOOR = 60.0, 0.12
#: Prior means: characters a word, symbols, capitals, punctuation and line breaks a word.
PRIOR = (5.5, 0.0, 0.15, 0.2, 0.03)
#: Distance buckets to an octave.
FINE = 16

MIN_WORDS, MAX_REPEAT_PCT = 10, 20


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """Base counts and raw statistics of each row."""
    text = null_safe(F.col(f"`{text_col}`"))
    length_of = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    d = docs.select(F.col(f"`{id_col}`").alias("id"), null_safe(F.col(f"`{lang_col}`")).alias("lang"),
                    null_safe(F.col(f"`{source_col}`")).alias("source"), text.alias("text"))
    d = d.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    d = d.select(
        "id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        length_of(SPACE).cast("long").alias("word_chars"), length_of(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        length_of(r"[^\p{Lu}]+").alias("n_capitals"), length_of(r"[\p{L}\p{N}\s#*$%&|<>]+").alias("n_punct"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    # hash of each five-word window by its position; texts under five words have none
    win = F.transform(F.sequence(F.lit(1), F.size("h") - 4), lambda i: F.xxhash64(*[F.get("h", i + (k - 1)) for k in range(5)]))
    d = d.withColumn("win", F.when(F.size("h") >= 5, win).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("distinct", F.size(F.array_distinct("win")))
    # windows in order of (hash, position): the repeated ones stand beside an equal one
    pairs = F.when(F.col("distinct") < F.size("win"), F.array_sort(F.transform(
        "win", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<w:bigint,i:int>>"))
    d = d.withColumn("sorted", pairs).drop("win", "distinct", "h")
    before = F.concat(F.array(F.lit(None).cast("struct<w:bigint,i:int>")), "sorted")
    after = F.slice("sorted", 2, F.greatest(F.size("sorted"), F.lit(1)))
    trios = F.arrays_zip(F.col("sorted").alias("x"), before.alias("p"), after.alias("n"))
    d = d.withColumn("trios", F.when(F.size("sorted") > 0, trios))
    at = F.array_sort(F.transform(F.filter("trios", lambda t: t["x"].isNotNull() & (
        (t["x"]["w"] == t["p"]["w"]) | (t["x"]["w"] == t["n"]["w"]))), lambda t: t["x"]["i"]))
    d = d.withColumn("at", at).drop("sorted", "trios")
    # each repeated window covers five words, less what the next one covers again
    gaps = F.transform(F.arrays_zip(F.col("at").alias("a"), F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))).alias("b")),
                       lambda x: F.coalesce(F.least(x["b"] - x["a"], F.lit(5)), F.lit(5)).cast("long"))
    repeat = F.when(F.size("at") > 0, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0))
    return d.select(
        "id", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words"), "n_capitals", "n_punct", F.size("lines").alias("n_lines"))


def vectors(counted: DataFrame) -> DataFrame:
    """Adds base_failed and the statistics x0..x4."""
    n = F.col("n_words").cast("double")
    shrunk = lambda c, prior: (F.col(c) + PRIOR_WORDS * prior) / (n + PRIOR_WORDS)
    rates = [shrunk(c, p) for c, p in zip(("word_chars", "n_symbols", "n_capitals", "n_punct", "n_lines"), PRIOR, strict=True)]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    out = counted.withColumn("base_failed", failed)
    for i, r in enumerate(rates):
        out = out.withColumn(f"x{i}", F.log(r if i == 0 else r + 0.1))
    return out


P = len(STATS)
X = [f"x{i}" for i in range(P)]
LOW = [(i, j) for i in range(P) for j in range(i + 1)]


def _consistency() -> float:
    """Covariance factor of the central SUBSET of a P-dimensional normal, by numeric integration."""
    def cdf(x: float, k: int) -> float:
        steps = 4000
        f = lambda t: t ** (k / 2 - 1) * math.exp(-t / 2)
        total = sum(f((s + 0.5) * x / steps) for s in range(steps)) * x / steps
        return total / (2 ** (k / 2) * math.gamma(k / 2))

    low, high = 0.0, 100.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid, P) < SUBSET else (low, mid)
    return SUBSET / cdf(low, P + 2)


def _bucket(d2: Column) -> Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(1e-6))) * FINE).cast("int")


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance from the columns x, m and the inverse factor w: |W (x - m)|^2."""
    total = F.lit(0.0)
    for i in range(P):
        total = total + F.pow(sum((F.col(f"w{i}{j}") * (F.col(X[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)), 2)
    return total


def _factored(est: DataFrame) -> DataFrame:
    """From columns c{i}{j} (covariance, lower half) the inverse of its Cholesky factor, w{i}{j}."""
    for i in range(P):
        for j in range(i + 1):
            s = F.col(f"c{i}{j}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i + 1):
            if i == j:
                w = 1.0 / F.col(f"l{i}{i}")
            else:
                w = -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}")
            est = est.withColumn(f"w{i}{j}", w)
    return est.select("g", "n", *[f"m{i}" for i in range(P)], *[f"w{i}{j}" for i, j in LOW])


def _quantile(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per key the value bucket (1/256 wide) that holds the ``share`` quantile; columns keys, q, n."""
    from pyspark.sql import Window

    b = rows.groupBy(*keys, F.floor(F.col("v") * 256).alias("b")).agg(F.count(F.lit(1)).alias("k"))
    run = Window.partitionBy(*keys).orderBy("b")
    every = Window.partitionBy(*keys)
    b = b.withColumn("upto", F.sum("k").over(run)).withColumn("n", F.sum("k").over(every))
    return (b.where(F.col("upto") >= F.ceil(F.col("n") * share)).groupBy(*keys)
            .agg(((F.min("b") + 0.5) / 256).alias("q"), F.first("n").alias("n")))


def _start(members: DataFrame) -> DataFrame:
    """Medians and median deviations as a first, diagonal estimate."""
    long = members.select("g", F.posexplode(F.array(*X)).alias("dim", "v"))
    med = written(_quantile(long, ["g", "dim"], 0.5), "mcd-median")
    dev = (long.join(med.select("g", "dim", "q"), ["g", "dim"])
           .select("g", "dim", F.abs(F.col("v") - F.col("q")).alias("v")))
    mad = written(_quantile(dev, ["g", "dim"], 0.5), "mcd-deviation")
    both = med.join(mad.select("g", "dim", F.col("q").alias("s")), ["g", "dim"])
    pick = lambda c, i: F.max(F.when(F.col("dim") == i, F.col(c)))
    est = both.groupBy("g").agg(F.max("n").alias("n"), *[pick("q", i).alias(f"m{i}") for i in range(P)],
                                *[pick("s", i).alias(f"s{i}") for i in range(P)])
    for i, j in LOW:
        est = est.withColumn(f"c{i}{j}", F.pow(1.4826 * F.col(f"s{i}"), 2) + FLOOR ** 2 if i == j else F.lit(0.0))
    return written(_factored(est), "mcd-start")


def _step(members: DataFrame, est: DataFrame, factor: float) -> DataFrame:
    """One concentration step: the estimate from the SUBSET of least distances."""
    from pyspark.sql import Window

    near = members.join(est, "g").withColumn("b", _bucket(_distance()))
    dev = [F.col(X[i]) - F.col(f"m{i}") for i in range(P)]
    by = near.groupBy("g", "b").agg(
        F.count(F.lit(1)).alias("k"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.sum(dev[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum(dev[i] * dev[j]).alias(f"s{i}{j}") for i, j in LOW])
    run = Window.partitionBy("g").orderBy("b")
    by = by.withColumn("upto", F.sum("k").over(run)).withColumn("n", F.sum("k").over(Window.partitionBy("g")))
    inside = by.where(F.col("upto") - F.col("k") < F.ceil(F.col("n") * SUBSET))
    tot = inside.groupBy("g").agg(
        F.first("n").alias("n"), F.sum("k").alias("k"), *[F.first(f"m{i}").alias(f"o{i}") for i in range(P)],
        *[(F.sum(f"s{i}") / F.sum("k")).alias(f"e{i}") for i in range(P)],
        *[(F.sum(f"s{i}{j}") / F.sum("k")).alias(f"q{i}{j}") for i, j in LOW])
    est = tot.select("g", "n", *[(F.col(f"o{i}") + F.col(f"e{i}")).alias(f"m{i}") for i in range(P)], *[
        ((F.col(f"q{i}{j}") - F.col(f"e{i}") * F.col(f"e{j}")) * factor + (FLOOR ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
        for i, j in LOW])
    return written(_factored(est), "mcd-step")


def _groups(rows: DataFrame) -> DataFrame:
    """A row for each group that a row is in, from the finest to the whole."""
    levels = F.array(F.struct(F.lit(0).alias("level"), F.to_json(F.struct("lang", "source")).alias("g")),
                     F.struct(F.lit(1).alias("level"), F.to_json(F.struct("lang")).alias("g")),
                     F.struct(F.lit(2).alias("level"), F.lit("all").alias("g")))
    return rows.withColumn("at", F.explode(levels)).select("*", "at.level", "at.g").drop("at")


def estimates(vecs: DataFrame) -> DataFrame:
    """Location and inverse factor of every group, from rows that pass the base rule."""
    members = _groups(vecs.where(~F.col("base_failed")).select("lang", "source", *X)).select("g", *X)
    est, factor = _start(members), _consistency()
    for _ in range(STEPS):
        est = _step(members, est, factor)
    return est


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Per row: id, the base counts, base_failed, distance (squared, null if base_failed) and kept."""
    vecs = written(vectors(counts(docs, id_col, text_col, lang_col, source_col)), "quality-vectors")
    est = estimates(vecs)
    # the finest group of each (lang, source) that has enough rows
    best = (_groups(vecs.select("lang", "source").distinct()).join(est, "g")
            .where((F.col("n") >= MIN_ROWS) | (F.col("level") == 2))
            .groupBy("lang", "source").agg(F.min_by(F.struct(*[c for c in est.columns if c != "g"]), "level").alias("e"))
            .select("lang", "source", "e.*").drop("n"))
    d2 = F.when(~F.col("base_failed"), _distance())
    out = vecs.join(written(best, "mcd-best"), ["lang", "source"], "left").withColumn("distance", d2)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUTOFF)
    return out.select("id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "distance", kept.alias("kept"), *X)


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns.

    Equal rows are judged alike, so a row is recognised by its id, text, language and
    source; what is rejected is joined back by their hash.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in (id_col, text_col, lang_col, source_col)])
    marked = docs.withColumn("__row", row)
    judged = judge(marked, "__row", text_col, lang_col, source_col)
    rejected = written(judged.where(~F.col("kept")).select(F.col("id").alias("__row")).distinct(), "quality-rejected")
    some, rest = split_by_filter(marked, "__row", rejected, "__row")
    return rest.unionByName(some.join(rejected, "__row", "left_anti")).select(*[f"`{c}`" for c in docs.columns])
