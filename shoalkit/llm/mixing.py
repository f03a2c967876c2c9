"""Mixing sources to target weights by entropy balancing.

Every document gets a rate r = min(cap, exp(lambda * size / mean size of its source)): of all
rates under the cap, these keep closest (in relative entropy) to taking each document once
while a source's words sum to its target. The multiplier of each source is the root of the
convex dual's gradient; all sources take a Newton step at once, kept inside a shrinking
bracket. A step needs only (source, size, documents), aggregated once, so an iteration is
one small job whatever the text size.

Rates become whole copies by systematic rounding: a source's cells (one size each, large
ones split by a hash of the id) are lined up by size, running totals of rates are rounded,
and a cell's extra copies go to its documents in hash order. Running totals are off by less
than one copy anywhere, so a source's words differ from its target by at most its largest
document.

Defined results: null and wordless texts have size 0 and take 0; the null source comes last
and is a source like any other; sources without words have target 0; repeated rows with the
same id are separate documents that may share their fate; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
#: Documents a cell aims at; larger groups of one size are split by the id's hash.
CELL = 512


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, u): words of the text, and a hash of the id."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    u = F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(1 << 40))
    return docs.select("doc_id", "source", size.alias("size"), u.alias("u"))


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, n, source_size, target) from per-source totals.

    Shares by weight with a ceiling: what ceilings cut off is shared again by weight, so
    open sources end at weight * level for one common level, found in a few passes.
    """
    order = W.orderBy(F.col("source").isNull(), "source")  # one row per source
    k = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    t = totals.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (k + 1).cast("int")))
    t = stored(t.withColumn("top", F.lit(float(cap)) * F.col("source_size")), "mix-sources")
    pool, level = None, 0.0
    while True:
        full = F.col("top") <= F.col("w") * F.lit(level)
        r = t.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("top")).otherwise(0.0)).alias("taken"),
                  F.sum(F.when(~full, F.col("w")).otherwise(0.0)).alias("w")).first()
        pool = share * float(r["all"] or 0)
        new = (pool - r["taken"]) / r["w"] if r["w"] else level
        if not r["w"] or new <= level:
            break
        level = new
    return t.select("source", "n", "source_size", F.least(F.col("top"), F.col("w") * F.lit(level)).alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(50.0))))


def _exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order in which partial sums meet, so that reruns agree."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def balance(groups: DataFrame, goal: DataFrame, cap: float, tol: float = 1e-7, steps: int = 60) -> DataFrame:
    """(source, target, source_size, mean, lam): the dual's root for each source.

    ``groups``: (source, size, n). lam is null where the target is the ceiling (every rate
    is the cap) and where there is nothing to take.
    """
    state = goal.withColumn("mean", F.col("source_size") / F.col("n"))
    edge = (F.col("target") >= F.lit(cap * (1 - 1e-12)) * F.col("source_size")) | (F.col("target") <= 0)
    state = state.withColumn("lam", F.when(~edge, F.lit(0.0))).withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
    g = groups.withColumnRenamed("source", "g_source").where("size > 0")
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        r = _rate(F.col("lam"), x, cap)
        words = F.col("size") * F.col("n_docs") * r
        at = g.withColumnRenamed("n", "n_docs").join(state.where("lam is not null"), F.col("g_source").eqNullSafe(F.col("source")))
        at = at.groupBy("source").agg(_exact_sum(words).alias("got"), _exact_sum(F.when(r < cap, words * x).otherwise(0.0)).alias("slope"))
        s = state.join(at.withColumnRenamed("source", "a_source"), F.col("source").eqNullSafe(F.col("a_source")), "left")
        off = F.col("got") / F.col("target") - 1
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        s = s.withColumn("off", off).withColumn("lo", lo).withColumn("hi", hi)
        newton = F.col("lam") + (F.col("target") - F.col("got")) / F.col("slope")
        # outside the bracket, or with no slope: halve the bracket, or widen it
        wide = F.when(F.col("off") < 0, F.when(F.col("lam") < 0, F.col("lam") / 2).otherwise(F.col("lam") * 2 + 1)).otherwise(F.col("lam") * 2 - 1)
        middle = F.coalesce((F.col("lo") + F.col("hi")) / 2, wide)
        inside = (F.col("slope") > 0) & (newton > F.coalesce("lo", F.lit(-1e18))) & (newton < F.coalesce("hi", F.lit(1e18))) & (F.abs(newton - F.col("lam")) < 8)
        done = F.col("lam").isNull() | (F.abs("off") <= tol)
        s = s.withColumn("next", F.when(done, F.col("lam")).when(inside, newton).otherwise(middle))
        s = stored(s.select("source", "n", "source_size", "target", "mean", F.col("next").alias("lam"), "lo", "hi", done.alias("done")), "mix-step")
        state = s.drop("done")
        if s.where("not done").isEmpty():
            break
    return state.select("source", "target", "source_size", "mean", "lam")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), rate, copies, taken."""
    d = stored(sizes(docs), "mix-sizes")
    groups = stored(d.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-groups")
    totals = groups.groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    lam = balance(groups, targets(totals, weights, share, cap), cap).withColumnRenamed("source", "l_source")
    # cells: how many documents of one size and hash range, and their place in the source's line
    split = F.ceil(F.col("n") / CELL)
    parts = groups.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), split.alias("parts"))
    cell = F.floor(F.col("u") * F.col("parts") / F.lit(1 << 40)).cast("int")
    d = d.join(parts, (F.col("size") == F.col("p_size")) & F.col("source").eqNullSafe(F.col("p_source"))).withColumn("cell", cell)
    d = d.select("doc_id", "source", "size", "u", "cell")
    cells = d.groupBy("source", "size", "cell").agg(F.count("*").alias("n"))
    cells = cells.join(lam, F.col("source").eqNullSafe(F.col("l_source")))
    rate = F.when((F.col("size") == 0) | (F.col("target") <= 0), 0.0).when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(_rate(F.col("lam"), F.col("size") / F.col("mean"), cap))
    cells = cells.withColumn("rate", rate)
    line = W.partitionBy("source").orderBy(F.col("size").desc(), "cell").rowsBetween(W.unboundedPreceding, 0)
    extra = F.col("n") * (F.col("rate") - F.floor("rate"))
    cells = cells.withColumn("upto", F.sum(extra).over(line))
    more = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - extra + 0.5)
    cells = cells.withColumn("more", F.greatest(F.lit(0), F.least(F.col("n"), more)))
    c = cells.select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("cell").alias("c_cell"), "rate", "more", "source_size", "target")
    d = d.join(c, (F.col("size") == F.col("c_size")) & (F.col("cell") == F.col("c_cell")) & F.col("source").eqNullSafe(F.col("c_source")))
    place = F.row_number().over(W.partitionBy("source", "size", "cell").orderBy("u", "doc_id"))
    copies = (F.floor("rate") + F.when(place <= F.col("more"), 1).otherwise(0)).cast("long")
    return d.withColumn("copies", copies).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: one row per document with its copies and words taken."""
    return mix(docs)
