"""Filter interaction audit: what each filter removes in every order of application.

Every text gets the bits of the filters it fails in one pass; a text's failing "identical
to a smaller id's" comes from counting copies by a hash of the text. Documents then shrink
to counts by mask cell (part, failed filters, lost labels). Higher-order SQL functions fold
each cell across the array of all orders: ``transform`` over the orders and ``aggregate``
over an order's steps give one weighted struct an order and step (600 for five filters),
and elementwise sums over a part's cells merge them.

Copies are counted before they meet: rows shrink to one a (text, part, mask, label, id), then
to one a (text, part, mask, label) with its smallest id, so a text that a third of all
documents hold is as many rows as it has kinds, whatever task gets it.

Defined results: a null text is the empty text; null and empty source are one part; a row
without id comes after all ids, and is a copy where a row with an id has its text; rows
that share id and text are no copies of each other, but all are where a smaller id has the
text; a labelled id with several labels counts as good or toxic where one of them is 1, a
null label as neither; labels without id count for nothing; an empty table gives no rows;
extra columns are ignored.
"""

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import UPPER, stored, table

#: The filters whose failing one text shows; a document fails COPY where a smaller id has its text.
TEXT_FILTERS, COPY = "ABCD", "E"
FILTERS = TEXT_FILTERS + COPY
STRUCT = "struct<kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>"
LAST = (1 << 63) - 1
BLANK = "\t\n\x0b\x0c\r"


def failed(text: Column) -> Column:
    """Bits of A (1), B (2), C (4) and D (8) that a text fails."""
    words = F.array_remove(F.split(F.translate(text, BLANK, " " * len(BLANK)), " "), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    signs = text.rlike("[#$%&*|]")
    tests = [n < 200, distinct * 100 < n * 50, capitals * 100 > F.length(text) * 2, signs]
    bits = [F.when(t, F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(tests)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def lost(labels: DataFrame) -> DataFrame:
    """(label_id, good, toxic) of the ids that have one of the two."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    out = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
    return out.agg(one("quality").alias("good"), one("toxic").alias("toxic")).where("good or toxic")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by what they fail and what their loss would cost."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("t"))
    d = d.select("doc_id", "part", F.sha2(F.col("t").cast("binary"), 256).alias("copy_of"), failed(F.col("t")).alias("mask"))
    d = stored(d, "audit-masks")  # each text is read once
    no = F.lit(False)
    d = d.join(lost(labels), F.col("doc_id") == F.col("label_id"), "left")
    d = d.select("part", "copy_of", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), F.coalesce("doc_id", F.lit(LAST)).alias("id"))
    kind = ["copy_of", "part", "mask", "good", "toxic"]
    d = d.groupBy(*kind, "id").agg(F.count("*").alias("c"))
    d = d.groupBy(*kind).agg(F.sum("c").alias("n"), F.min(F.struct("id", "c")).alias("first"))
    least = d.groupBy(F.col("copy_of").alias("of")).agg(F.min("first.id").alias("least"), F.count("*").alias("kinds"))
    several = least.where("kinds > 1").select("of", "least")
    d = d.join(several, F.col("copy_of") == F.col("of"), "left")
    own = F.when(F.coalesce("least", "first.id") == F.col("first.id"), F.col("first.c")).otherwise(F.lit(0))
    d = d.select("part", "mask", "good", "toxic", "n", own.alias("own"))
    d = d.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
    copy = F.lit(1 << FILTERS.index(COPY))
    d = d.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("own")).alias("n")))).alias("x"))
    return d.select("part", "x.mask", "good", "toxic", "x.n")


def orders(filters: str = FILTERS) -> Column:
    """The array of all orders of application, each an array of filter letters."""
    return F.split(F.lit(",".join("".join(p) for p in permutations(filters))), ",")


def folded(mask: Column, n: Column, good: Column, toxic: Column, order: Column, filters: str) -> Column:
    """One struct a step of ``order``: what becomes of a cell of ``n`` documents that fail ``mask``."""
    letters = F.split(order, "")  # an empty end is left out by the step's number
    bit = {c: 1 << k for k, c in enumerate(filters)}

    def fails(letter: Column) -> Column:
        out = F.lit(False)
        for c, b in bit.items():
            out = out | ((letter == c) & (mask.bitwiseAND(F.lit(b)) != 0))
        return out

    def only(letter: Column) -> Column:
        out = F.lit(False)
        for c, b in bit.items():
            out = out | ((letter == c) & (mask == b))
        return out

    def step(acc: Column, letter: Column) -> Column:
        fail = fails(letter)
        here = acc["alive"] & fail
        weigh = lambda test: F.when(test, n).otherwise(F.lit(0)).cast("bigint")
        one = F.struct(weigh(acc["alive"] & ~fail).alias("kept"), weigh(here).alias("removed"), weigh(~acc["alive"] & fail).alias("redundant"),
                       weigh(only(letter)).alias("unique_fails"), weigh(here & good).alias("good_lost"), weigh(here & toxic).alias("toxic_lost"))
        return F.struct((acc["alive"] & ~fail).alias("alive"), F.concat(acc["steps"], F.array(one)).alias("steps"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{STRUCT}>").alias("steps"))
    return F.aggregate(F.slice(letters, 1, len(filters)), start, step, lambda acc: acc["steps"])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    k = len(FILTERS)
    d = cells(docs, labels)
    each = F.flatten(F.transform(orders(), lambda o: folded(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic"), o, FILTERS)))
    d = d.select("part", F.posexplode(each).alias("at", "x"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    d = d.groupBy("part", "at").agg(*[F.sum(f"x.{c}").alias(c) for c in names])
    order = F.get(orders(), F.floor(F.col("at") / k).cast("int"))
    d = d.withColumn("filter_order", order).withColumn("step", (F.col("at") % k + 1).cast("int"))
    d = d.withColumn("letter", F.col("filter_order").substr(F.col("step"), F.lit(1)))
    d = d.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))  # 120 rows a window
    return d.select("part", "filter_order", "step", *names, "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_OP12 = r"""
WITH RECURSIVE d AS (SELECT coalesce(doc_id, 9223372036854775807) AS id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
    'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), 'D': regexp_matches(t, '[#$%&*|]'), 'E': id > least} AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.id),
o AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || c FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE length(filter_order) < 5 AND NOT contains(filter_order, c)),
c AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
s AS (
  SELECT part, filter_order, step, good, toxic, n, filter_order[step] AS letter, fails[filter_order[step]] AS hit,
    len(list_filter(range(1, step), lambda i: fails[filter_order[i]])) > 0 AS gone,
    len(list_filter(map_values(fails), lambda x: x)) AS failed
  FROM c, o, (SELECT unnest(range(1, 6)) AS step) WHERE length(filter_order) = 5),
r AS (
  SELECT part, filter_order, step, any_value(letter) AS letter,
    sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND hit THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND hit THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
