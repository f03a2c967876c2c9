"""Benchmark decontamination: prefix-filtered set join, DataFrame operations only.

Items are cut into windows of ``width`` consecutive words (a shorter item is one
window). A window occurs in a document only if every shingle of the window does, so the
necessary prefix is one shingle: the one rarest in the corpus. Corpus counts of the
items' shingles give the order, each document position looks its shingle up among the
prefixes, the position and length bounds place the window inside the document, and the
words under it are compared exactly.

Defined results: null or wordless texts have no words and no hits; repeated rows are
judged row by row; items without words have no window; an item without id can hit but
is not listed; empty tables give no rows or no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, stored, table

#: What separates words, before lower-casing (A-Z are kept until then).
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Prefix tables are broadcast up to this size, measured first; beyond it they are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), "")


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """(item_id, win, len): the distinct windows of every item."""
    w = items.select("item_id", words_of(ascii_lower(F.col("text"))).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(width)))
    w = w.select("item_id", "len", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("s"))
    return w.select("item_id", "len", F.array_join(F.slice("w", F.col("s"), F.col("len")), " ").alias("win")).distinct()


def _positions(docs: DataFrame, k: int, keep_words: bool) -> DataFrame:
    """A row for each word position with the hash of the ``k`` words that start there."""
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    d = d.select("doc_id", "th", "words", F.posexplode_outer("words").alias("pos", "word"))  # outer: no filter that splits again
    shingle = [F.lower("word")] + [F.lower(F.get("words", F.col("pos") + j)) for j in range(1, k)]
    return d.select("doc_id", "th", *(["words"] if keep_words else []), "pos", F.xxhash64(*shingle).alias("h"))


def _fits(df: DataFrame, text: str | None = None) -> bool:
    width = F.lit(64) + (F.octet_length(text) if text else F.lit(0))
    return (df.agg(F.sum(width).alias("b")).first()["b"] or 0) <= BROADCAST_BYTES


def occurrences(docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3) -> DataFrame:
    """(doc_id, th, start, len, win): every place a window occurs; th is the text's hash."""
    wins = windows_of(items, width).select("win", "len").distinct()
    wins = stored(wins.withColumn("k", F.least("len", F.lit(shingle))), "windows")
    found = None
    for k in sorted(r["k"] for r in wins.select("k").distinct().collect()):  # at most `shingle` values
        w = wins.where(F.col("k") == k).withColumn("a", F.split("win", " "))
        w = w.select("win", "len", "a", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("off"))
        w = w.select("win", "len", "off", F.xxhash64(*[F.lower(F.get("a", F.col("off") + j)) for j in range(k)]).alias("h"))
        keys = w.select("h").distinct()
        keys = F.broadcast(keys) if _fits(keys) else keys
        seen = _positions(docs, k, False).join(keys, "h").groupBy("h").agg(F.count("*").alias("n"))
        rank = F.row_number().over(W.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "off"))
        prefix = w.join(seen, "h", "left").withColumn("r", rank).where("r = 1").select("h", "off", "len", "win")
        inside = (F.col("pos") >= F.col("off")) & (F.col("pos") - F.col("off") + F.col("len") <= F.size("words"))
        same = F.translate(F.array_join(F.slice("words", F.col("start") + 1, F.col("len")), " "), UPPER, LOWER) == F.col("win")
        if _fits(prefix, "win"):
            at = F.col("pos") - F.col("off")
            same = F.translate(F.array_join(F.slice("words", at + 1, F.col("len")), " "), UPPER, LOWER) == F.col("win")
            p = F.broadcast(prefix.withColumnRenamed("h", "ph"))
            hit = _positions(docs, k, True).join(p, (F.col("h") == F.col("ph")) & F.when(inside, same).otherwise(False))
            hit = hit.select("doc_id", "th", at.alias("start"), "len", "win")
        else:
            c = _positions(docs, k, False).join(prefix, "h").where("pos >= off")
            c = c.select(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th"), (F.col("pos") - F.col("off")).alias("start"), "len", "win")
            d = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words")).dropDuplicates(["doc_id", "th"])
            hit = c.join(d, (F.col("th") == F.col("c_th")) & F.col("doc_id").eqNullSafe(F.col("c_id")))
            hit = hit.where(F.col("start") + F.col("len") <= F.size("words")).where(same).select("doc_id", "th", "start", "len", "win")
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, th long, start int, len int, win string")
    return found


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words under any window), n_items, items_sha256, contaminated."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    occ = stored(occurrences(docs, items, width, shingle), "window-hits")
    key = ["doc_id", "th"]
    # one shuffle by document: words covered by the union of its windows, and the distinct windows
    before = W.partitionBy(*key).orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    occ = occ.withColumn("prev", F.max(end).over(before))
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("prev", "start")))
    # repeated rows bring the same interval again and add nothing
    covered = occ.groupBy(*key, "win").agg(F.sum(new).alias("add"))
    named = windows_of(items, width).where("item_id is not null").select(F.col("win").alias("iwin"), F.col("item_id").cast("string").alias("item"))
    named = covered.join(named, F.col("win") == F.col("iwin"), "left").select(*key, "item").groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = covered.groupBy(*key).agg(F.sum("add").alias("n_hit"))
    hits = hits.join(named.select(F.col("doc_id").alias("n_id"), F.col("th").alias("n_th"), "items"),
                     (F.col("th") == F.col("n_th")) & F.col("doc_id").eqNullSafe(F.col("n_id")))
    hits = hits.select(F.col("doc_id").alias("h_id"), F.col("th").alias("h_th"), "n_hit", "items")
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    out = d.join(hits, (F.col("th") == F.col("h_th")) & F.col("doc_id").eqNullSafe(F.col("h_id")), "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which no benchmark window occurs."""
    occ = occurrences(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = occ.select(F.col("doc_id").alias("b_id"), "th").distinct()
    return docs.join(bad, (F.xxhash64(docs["text"]) == bad["th"]) & docs["doc_id"].eqNullSafe(bad["b_id"]), "left_anti")


ORACLE_OP7 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM iw)),
pos AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT p.doc_id, p.s, p.n, w.item_id FROM pos p JOIN win w ON p.win = w.win AND p.n = w.n),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS q FROM occ) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN it i USING (doc_id)
"""
