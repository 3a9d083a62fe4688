"""Links among rows that share signatures, and the components of a link table.

All tables here are (id, id) or (signature, id) rows of integers, written between
steps. Joins are plain equi-joins of written tables, which adaptive execution
splits where one key is hot; aggregates combine on the map side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.bucket_pairs import candidates
from ledgerlens.llm.common import discard, maybe_in, written


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``links`` (a, b): distributed union-find by least ids.

    Each round gives an id the least label among its neighbours and itself, then
    that label's own label (pointer jumping), until nothing changes. ``comp`` is the
    least id that can be reached.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where(F.col("a") != F.col("b")).distinct(), "cc-edges")
    label = nxt = written(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp")), "cc-label")
    while True:
        near = (both.join(label.select(F.col("id").alias("b"), F.col("comp").alias("l")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("l").alias("l")))
        hooked = near.join(label, "id").select("id", F.least("l", "comp").alias("l"), F.col("comp").alias("was"))
        jump = label.select(F.col("id").alias("l"), F.col("comp").alias("j"))
        was, nxt = nxt, written(hooked.join(jump, "l", "left").select(
            "id", F.least("l", F.coalesce("j", "l")).alias("comp"), "was"), "cc-next", release=True)
        discard(was)
        label = nxt.select("id", "comp")
        if not nxt.where(F.col("comp") != F.col("was")).limit(1).count():
            discard(both)
            return label


def links_in_buckets(rows: DataFrame, sizes: DataFrame, verify: Callable[..., DataFrame],
                     percent: int) -> DataFrame:
    """Verified links (a, b) whose components are those of all pairs of ids in a common bucket that link.

    ``rows`` are distinct (sig, id) of signatures that two or more ids hold,
    ``sizes`` (id, n, sketch) their sets' sizes and parity sketches; ``verify`` keeps the pairs (a, b) that
    really link, which takes a Jaccard similarity of ``percent``. First each id is tried against the least id of its
    buckets; that joins large groups of near copies with a pair an id. In buckets that still hold several components
    the pairs of a spanning forest of these are tried, the nearest by their sketches; that joins the groups
    whose members link to each other but not to the least one, without a row for each of their pairs.
    What is left are buckets of components that did not link: there every pair of ids in different components is tried
    that can link by its sizes and by the distance of its sketches, a lower bound on that of the sets. No other pair of a bucket is
    left out unless a chain of links joins it already.
    """
    hubs = written(rows.groupBy("sig").agg(F.min("id").alias("hub")), "hubs")
    star = (rows.join(hubs, "sig").where(F.col("id") != F.col("hub"))
            .groupBy(F.col("id").alias("b")).agg(F.min("hub").alias("a")))
    tried = [written(star.select("a", "b"), "star-pairs", release=True)]
    links = verify(tried[0])
    discard(hubs)
    for forest in (True, False):
        rest = _mixed(rows, components(links))
        full = written(rest.join(sizes.select("id", "n", "sketch"), "id"), "bucket-rest", release=True)
        pairs = candidates(full, percent, forest)
        for t in tried:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        tried.append(written(pairs, "bucket-pairs", release=True))
        discard(full)
        links = written(links.unionByName(verify(tried[-1], sketched=True)), "links")
        rows = rest.select("sig", "id")
    return links


def _mixed(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """(sig, id, comp, k) of the buckets that hold ids of several components, and of how many ids."""
    known = written(rows.join(comps, "id", "left").select("sig", "id", F.coalesce("comp", "id").alias("comp")), "bucket-comps", release=True)
    mixed = written(known.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("k"))
                    .where(F.col("lo") < F.col("hi")).select("sig", "k"), "bucket-mixed")
    out = written(known.join(mixed, "sig"), "bucket-rows", release=True)
    discard(known, mixed)
    return out


def _may_link(percent: int) -> Column:
    """Whether sets of sizes n1, n2 with parity sketches sketch1, sketch2 can have that similarity."""
    apart = F.aggregate(F.zip_with("sketch1", "sketch2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    # sets with that similarity differ in so many features at most
    bound = F.floor((F.col("n1") + F.col("n2")) * (100 - percent) / (100 + percent))
    near = F.when(F.size("sketch1") == F.size("sketch2"), apart <= bound).otherwise(F.lit(True))
    return (F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent) & near


def verifier(sets: DataFrame, percent: int) -> Callable[[DataFrame], DataFrame]:
    """Keeps the pairs whose sets satisfy 100 * intersection >= percent * union.

    ``sets`` is (id, n, sketch, set array<long>). Sizes and sketches, narrow rows, decide most
    pairs; only the sets of the pairs that are left are moved.
    """
    def side(k: int, key: str) -> DataFrame:
        return sets.select(F.col("id").alias(key), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"sketch{k}"))

    def verify(pairs: DataFrame, sketched: bool = False) -> DataFrame:
        """``pairs`` that link; ``sketched``: their sizes and sketches were looked at already."""
        close = pairs if sketched else written(
            pairs.join(side(1, "b"), "b").join(side(2, "a"), "a").where(_may_link(percent)).select("a", "b"), "close-pairs", release=True)
        one = maybe_in(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b", close, "b")
        two = maybe_in(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a", close, "a")
        both = close.join(one, "b").join(two, "a")
        common = F.size(F.array_intersect("x", "y")).cast("long")
        union = F.size("x") + F.size("y") - F.col("i")
        return written(both.withColumn("i", common).where(F.col("i") * 100 >= union * percent).select("a", "b"), "verified", release=True)

    return verify
