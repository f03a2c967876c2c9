"""Document fingerprints from closed syncmers, DataFrame operations only.

A text is read as symbols: runs of letters or digits cut every ``PIECE`` characters, and
any other non-space character alone; letters of scripts written without spaces, and those
of a run that come after its first ``RUN``, are symbols of their own, so that an insertion
shifts the cuts of a short run at most. Of the ``K`` symbols in a row (the k-mer), inner
substrings are ``S`` symbols long; the k-mer is an anchor when its smallest inner
substring (by hash) is the first or the last one. That depends on the k-mer alone, so an
edit moves no anchor outside its reach. An anchor is a hash and a position (the number of
its first symbol); the fingerprint lists the hashes in text order. ``likeness`` is shared
over all distinct anchors (Jaccard); ``chain_likeness`` compares each anchor with its
successor and how often they occur, so that repeats and passages in another order count; ``positions`` gives an anchor's places in a text for positional matching.

Symbols instead of single characters: SQL functions take about 1 microsecond per element,
and the corpus has several characters per symbol; the scheme itself is unchanged.

The next document is found without a global sort of the texts: id buckets of bounded text
size hold their rows plus a copy of the first row of the following bucket.

Defined results: null and empty texts have no anchor and an empty fingerprint, a text with
fewer than K symbols is one anchor; two empty fingerprints are alike 1, an empty and a
non-empty one 0; rows with equal ids are ordered by text, null ids come first; the last
document is followed by the first (a single one by itself); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

PIECE, RUN, K, S = 4, 24, 6, 2
#: Scripts written without spaces between words (fixed values).
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
SYMBOL = rf"[{UNSPACED}]|(?<=[\p{{L}}\p{{N}}]{{{RUN}}})[\p{{L}}\p{{N}}]|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]{{1,{PIECE}}}|[^\s\p{{L}}\p{{N}}]"
#: Characters of text an id bucket aims at.
BUCKET_CHARS = 8 << 20
MAX_BUCKETS = 8192


def _anchors(symbols: Column, places: bool = False) -> Column:
    """Closed syncmers of an array of symbols, as 64-bit hashes (or positions) in text order."""
    inner = K - S  # index of a k-mer's last inner substring

    def pick(subs: Column) -> Column:
        def edge(i):
            return F.least(F.get(subs, i), F.get(subs, i + inner)) <= F.least(*[F.get(subs, i + j) for j in range(1, inner)])

        at = F.filter(F.sequence(F.lit(0), F.size(symbols) - K), edge)
        if places:
            return at
        return F.transform(at, lambda i: F.xxhash64(*[F.get(subs, i + j) for j in range(0, inner + 1, S)]))

    hashed = F.transform(F.slice(symbols, 1, F.size(symbols) - (S - 1)),
                         lambda w, i: F.xxhash64(w, *[F.get(symbols, i + j) for j in range(1, S)]))
    subs = F.flatten(F.transform(F.array(hashed), pick))
    whole = F.array(F.lit(0)) if places else F.array(F.xxhash64(F.array_join(symbols, " ")))
    return F.when(F.size(symbols) == 0, F.array().cast("array<int>" if places else "array<bigint>")).when(F.size(symbols) < K, whole).otherwise(subs)


def symbols_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SYMBOL), F.lit(0))


def fingerprint_text(anchors: Column) -> Column:
    """Each anchor as 8 hex digits (its low 32 bits), one after the other."""
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.lower(F.hex(a.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two anchor lists."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    na, nb = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    return F.when((na + nb) == 0, F.lit(1.0)).otherwise(both / (na + nb - both))


def _chain(anchors: Column) -> Column:
    """Each anchor with its successor (0 after the last); the first four of equal links differ."""
    links = F.transform(anchors, lambda a, i: F.xxhash64(a, F.coalesce(F.get(anchors, i + 1), F.lit(0).cast("bigint"))))

    def numbered(x: Column, i: Column, ordered: Column) -> Column:
        before = [F.coalesce(F.get(ordered, i - j) == x, F.lit(False)).cast("int") for j in (1, 2, 3)]
        return F.xxhash64(x, before[0] + before[1] + before[2])

    return F.flatten(F.transform(F.array(F.array_sort(links)), lambda o: F.transform(o, lambda x, i: numbered(x, i, o))))


def chain_likeness(a: Column, b: Column) -> Column:
    """Shared links of two anchor lists, each as often as both have it (four times at most), over all links."""
    return likeness(_chain(a), _chain(b))


def positions(docs: DataFrame) -> DataFrame:
    """Per row and anchor: doc_id, at (number of its first symbol), anchor."""
    d = docs.select("doc_id", symbols_of(F.col("text")).alias("s"))
    d = d.select("doc_id", F.flatten(F.transform(F.array("s"), lambda s: _anchors(s, True))).alias("at"), F.flatten(F.transform(F.array("s"), lambda s: _anchors(s))).alias("anchor"))
    return d.select("doc_id", F.explode(F.arrays_zip("at", "anchor")).alias("x")).select("doc_id", F.col("x.at").alias("at"), F.col("x.anchor").alias("anchor"))


def _bucket(col: Column, cuts: list[int], lo: int = 0) -> Column:
    """Number of sorted cuts at or below ``col``, by halving."""
    if not cuts:
        return F.lit(lo)
    m = len(cuts) // 2
    return F.when(col < cuts[m], _bucket(col, cuts[:m], lo)).otherwise(_bucket(col, cuts[m + 1:], lo + m + 1))


def with_next(docs: DataFrame) -> DataFrame:
    """Each row with ``next_text``, the text of the row that follows by (doc_id, text).

    Cuts are ids that occur, so every bucket's first id is known beforehand: its rows are
    also sent to the bucket before (z = 1), the first bucket's to the last one.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    s = d.agg(F.sum(F.length("text") + 64).alias("chars"), F.min("doc_id").alias("lo"),
              F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    n = min(MAX_BUCKETS, int((s["chars"] or 0) // BUCKET_CHARS) + 1)
    cuts = []
    if n > 1 and s["lo"] is not None:
        q = d.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"]
        cuts = sorted({c for c in q if c > s["lo"]})
    id_ = F.col("doc_id")
    b = F.when(id_.isNull(), F.lit(0)).otherwise(_bucket(id_, cuts))
    first = id_.isNull() if s["nulls"] else id_ == F.lit(s["lo"])
    heads = first | id_.isin(cuts) if cuts else first
    d = d.withColumn("b", b.cast("int"))
    before = F.when(F.col("b") == 0, F.lit(len(cuts))).otherwise(F.col("b") - 1)
    here = F.struct(F.col("b"), F.lit(0).alias("z"))
    also = F.struct(before.cast("int").alias("b"), F.lit(1).alias("z"))
    d = d.select("doc_id", "text", F.explode(F.when(heads, F.array(here, also)).otherwise(F.array(here))).alias("at"))
    d = d.select("at.b", "at.z", "doc_id", "text").repartition(F.col("b"))
    return d.withColumn("anchors", _anchors_of("text"))


def _anchors_of(name: str) -> Column:
    # one level of transform binds the symbols, so that they are found once
    return F.flatten(F.transform(F.array(symbols_of(F.col(name))), lambda s: _anchors(s)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_anchors."""
    w = W.partitionBy("b").orderBy("z", F.col("doc_id").asc_nulls_first(), "text")
    d = with_next(docs).select("*", F.lead("text").over(w).alias("next_text"), F.lead("anchors").over(w).alias("next_anchors"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    d = d.where("z = 0").select("doc_id", n.cast("long").alias("n_chars"), "anchors", "next_anchors", edited.alias("edited"))
    d = d.select("doc_id", "n_chars", "anchors", "next_anchors", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                 F.explode(F.array(_anchors_of("edited"))).alias("edited_anchors"))
    return d.select("doc_id", "n_chars", "edited_sha256",
                    fingerprint_text(F.col("anchors")).alias("fingerprint"), fingerprint_text(F.col("edited_anchors")).alias("edited_fingerprint"),
                    likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
                    likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
                    F.size("anchors").cast("long").alias("n_anchors"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
