"""N-gram Jaccard join by universe partitioning and pigeonhole.

A document is the set of its distinct word shingles, as 64-bit hashes. Two sets with
Jaccard likeness of at least t differ in at most c * (|x| + |y|) shingles, c = (1-t)/(1+t).
Size bands fix a number of segments the hash range is cut into, a few more than the largest
difference possible in the band: two linked sets agree on whole segments, and each needs to
index only a subset of its segments. Which ones and how is a matter of cost: segments with
most shingles go first (they are shared least by chance), and where segments would be so
small that chance matches cost more, half as many are indexed with their one-deletion
neighbourhood, which tolerates one difference each.

Only connected groups are needed, so no group is expanded into all its pairs: equal sets are
one class. Each segment's most shared class is a hub, and all that share the segment belong
to the hub's group; a class is first held against its best hub. What is not connected by
then is compared within groups by a lower bound of the difference (counts over 256 hash
cells, block by block), and pairs that pass are verified exactly unless they met meanwhile.

Defined results: null, empty and wordless texts have the empty set, link with nothing and
are their own component; a text with fewer words than a shingle is one shingle; repeated
rows and rows sharing an id share a component; rows without id have no component and link
nothing; an empty table gives no rows; extra columns are ignored.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: Bytes of text worked on at a time, rows of a block, rows of a group of blocks, ids broadcast at most (8 bytes each).
CHUNK, BLOCK, ROWS, IDS = 1 << 21, 2000, 10_000, 2_000_000
U = np.uint64
CELLS = 256
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_R = U(0x9E3779B97F4A7C15)
_RINV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): each text's distinct shingles, sorted, one after the other."""
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(_LOW) for t in texts]
    b = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends_of = np.cumsum([len(r) + 1 for r in raw])
    sep = _SEP[b]
    edge = np.flatnonzero(np.diff(sep.astype(np.int8), prepend=1, append=1))
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + U(1)) * _powers(_R, len(b)), out=total[1:])
    w = _mix((total[end] - total[start]) * _powers(_RINV, len(b))[start] + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    doc = np.searchsorted(ends_of, start, side="right")
    factor = _powers(U(0xA0761D6478BD642F), k + 1)[1:]
    n = np.bincount(doc, minlength=len(texts))
    hashes, owner = [], []
    if len(w) >= k:
        m = len(w) - k + 1
        h = np.zeros(m, dtype=np.uint64)
        for j in range(k):
            h += w[j:m + j] * factor[j]
        ok = doc[:m] == doc[k - 1:]
        hashes.append(_mix(h[ok])), owner.append(doc[:m][ok])
    few = (n > 0) & (n < k)
    if few.any():
        at = few[doc]
        first = np.cumsum(n) - n
        part = w[at] * factor[(np.arange(len(w)) - first[doc])[at]]
        s = np.zeros(len(texts), dtype=np.uint64)
        np.add.at(s, doc[at], part)
        hashes.append(_mix(s[few] + n[few].astype(np.uint64))), owner.append(np.flatnonzero(few))
    if not hashes:
        return np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h, d = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(texts)))]), h


class Plan:
    """Segments by size band, for a threshold of ``percent`` / 100."""

    def __init__(self, percent: int, ratio: float = 1.4):
        self.t = percent / 100
        self.c = (1 - self.t) / (1 + self.t)
        self.percent, self.ratio = percent, ratio
        self.low = [1]

    def band(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * self.ratio)))
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def scheme(self, band: int) -> tuple[int, bool] | None:
        """(segments, with deletions) of a band, or None where only equal sets link."""
        self.band(self.low[band] * 3 + 3)
        top = self.low[band + 1] - 1
        worst = int(self.c * 2 * top + 1e-9)
        if worst == 0:
            return None
        whole = worst + 1 + 2 + worst // 8
        half = worst // 2 + 1 + 2 + worst // 16

        def cost(rows, tokens):  # rows written, and chance matches of so few shingles
            return rows * (1 + 200 * np.exp(-tokens))

        a, b = top / whole, top / half
        return (half, True) if cost(half * (1 + b), b - 1) < cost(whole, a) else (whole, False)

    def spare(self, m: int, deletions: bool, size: np.ndarray) -> np.ndarray:
        """How many of ``m`` segments a set may leave out: both together leave one agreeing segment in."""
        worst = self.c * size * (0.5 if deletions else 1.0)
        return np.maximum(0, np.floor((m - 1) / 2 - worst - 1e-9)).astype(np.int64)

    def bands_of(self, size: int) -> list[int]:
        """Bands a partner of at least this size may lie in."""
        b = self.band(size)
        out = [b]
        while True:
            b += 1
            self.band(self.low[b])
            if size < self.t * self.low[b] - 1e-9:
                return out
            out.append(b)


def signatures(plan: Plan, offsets: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Signatures of each set: hashes of the segments it indexes (and of those less one shingle)."""
    sizes = np.diff(offsets)
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    mixed = _mix(h * U(0xC2B2AE3D27D4EB4F) + U(1))
    member: dict[int, list[int]] = {}
    bands: dict[int, list[int]] = {}
    for i, s in enumerate(sizes.tolist()):
        if s:
            for b in bands.setdefault(s, plan.bands_of(s)):
                member.setdefault(b, []).append(i)
    for b, docs in member.items():
        scheme = plan.scheme(b)
        if scheme is None:
            continue
        m, deletions = scheme
        docs = np.array(docs)
        n = sizes[docs]
        local = np.repeat(np.arange(len(docs)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[docs], n)
        seg = (((h[at] >> U(32)) * U(m)) >> U(32)).astype(np.int64)
        cell = local * m + seg  # sorted, as hashes are
        count = np.bincount(cell, minlength=len(docs) * m)
        total = np.zeros(len(docs) * m, dtype=np.uint64)
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        total[cell[first]] = np.add.reduceat(mixed[at], first)
        salt = _mix(np.arange(m, dtype=np.uint64) + U(b * 1_000_003 + 17))
        sig = _mix(total + np.tile(salt, len(docs)) + count.astype(np.uint64)).reshape(len(docs), m)
        grid = count.reshape(len(docs), m)
        rank = np.argsort(np.argsort(-grid, axis=1, kind="stable"), axis=1, kind="stable")
        keep = rank < (m - plan.spare(m, deletions, n))[:, None]
        for i, d in enumerate(docs.tolist()):
            out[d].append(sig[i][keep[i]])
        if deletions:
            less = _mix(total[cell] - mixed[at] + salt[seg] + count[cell].astype(np.uint64) - U(1))
            wanted = keep.ravel()[cell]
            parts = np.split(np.arange(len(at)), np.cumsum(n)[:-1])
            for i, d in enumerate(docs.tolist()):
                out[d].append(less[parts[i]][wanted[parts[i]]])
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, dtype=np.uint64) for x in out]


def _chunks(texts):
    """Index ranges of about CHUNK bytes of text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _sets(k: int):
    """(doc_id, n, k1, k2): size and 128-bit name of each text's set."""
    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            for i, j in _chunks(texts):
                off, h = shingle_sets(texts[i:j], k)
                n = np.diff(off)
                keys = np.zeros((2, j - i), dtype=np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    for r in (0, 1):
                        keys[r][full] = np.add.reduceat(_mix(h + U(0x1234567 + 77 * r)), off[:-1][full])
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[i:j].to_numpy(), "n": n, "k1": keys[0].view(np.int64), "k2": keys[1].view(np.int64)})
    return run


def _signed(k: int, percent: int):
    """(doc_id, sigs) of each set."""
    def run(batches):
        plan = Plan(percent)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for i, j in _chunks(texts):
                sigs = signatures(plan, *shingle_sets(texts[i:j], k))
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[i:j].to_numpy(), "sigs": [s.view(np.int64) for s in sigs]})
    return run


def _cells(k: int):
    """(r_id, n, cells): size of each set and its counts over CELLS hash cells (255 at most, so bounds hold)."""
    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            for i, j in _chunks(texts):
                off, h = shingle_sets(texts[i:j], k)
                n = np.diff(off)
                c = np.bincount(np.repeat(np.arange(j - i), n) * CELLS + (h & U(CELLS - 1)).astype(np.int64), minlength=(j - i) * CELLS)
                c = np.minimum(c, 255).astype(np.uint8).reshape(-1, CELLS)
                yield pd.DataFrame({"r_id": pdf["doc_id"].iloc[i:j].to_numpy(), "n": n, "cells": [x.tobytes() for x in c]})
    return run


def _few(df: DataFrame, col: str) -> DataFrame:
    """Ids marked for broadcast where they are few enough to fit (8 bytes each), else as they are."""
    df = df.select(col).distinct()
    return F.broadcast(df) if df.count() <= IDS else df


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over ``edges`` (a, b), for every id on an edge."""
    e = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    lab = stored(e.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "cc-labels")
    while True:
        near = e.join(lab.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("n_id")).agg(F.min("comp").alias("n_comp"))
        step = lab.join(near, F.col("id") == F.col("n_id")).select("id", "comp", F.least("comp", "n_comp").alias("to"))
        jump = lab.select(F.col("id").alias("j_id"), F.col("comp").alias("j_comp"))
        new = step.join(jump, F.col("to") == F.col("j_id"), "left").select("id", "comp", F.least("to", F.coalesce("j_comp", "to")).alias("to"))
        new = stored(new, "cc-step")
        lab = new.select("id", F.col("to").alias("comp"))
        if new.where("to <> comp").isEmpty():
            return lab


def _verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) among ``pairs`` (x, y, cx, cy, gx, gy), enough to connect what they connect.

    cx, cy: components so far; gx, gy: groups whose members tend to be paired. A task has the
    pairs of two parts of a group; each text comes once to a task that needs it.
    """
    sizes = pairs.select(F.col("gx").alias("g"), F.col("x").alias("d")).unionByName(pairs.select(F.col("gy").alias("g"), F.col("y").alias("d")))
    sizes = sizes.groupBy("g").agg(F.approx_count_distinct("d").alias("n")).withColumn("parts", F.ceil(F.col("n") / 500)).where("parts > 1").select("g", "parts")
    for s in "xy":
        pairs = pairs.join(sizes.withColumnRenamed("g", f"g{s}").withColumnRenamed("parts", f"p{s}"), f"g{s}", "left")
        pairs = pairs.withColumn(f"i{s}", F.pmod(F.xxhash64(s), F.coalesce(f"p{s}", F.lit(1))))
    pairs = stored(pairs.select("x", "y", "cx", "cy", F.xxhash64("gx", "gy", "ix", "iy").alias("task")), "join-pairs")
    need = pairs.select("task", F.col("x").alias("d")).unionByName(pairs.select("task", F.col("y").alias("d"))).distinct()
    text = docs.join(_few(need, "d"), F.col("doc_id") == F.col("d"), "left_semi").dropDuplicates(["doc_id"])
    text = need.join(text, F.col("d") == F.col("doc_id")).select(F.col("task").alias("t_task"), "doc_id", "text")

    def check(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, texts = right["doc_id"].tolist(), right["text"].tolist()
        sets = {}
        for i, j in _chunks(texts):
            off, h = shingle_sets(texts[i:j], k)
            sets |= {d: h[off[r]:off[r + 1]] for r, d in enumerate(ids[i:j])}
        up: dict[int, int] = {}

        def root(c):
            while up.get(c, c) != c:
                c = up[c] = up.get(up[c], up[c])
            return c

        out = []
        for x, y, cx, cy in left[["x", "y", "cx", "cy"]].itertuples(index=False):
            rx, ry = root(cx), root(cy)
            if rx == ry:
                continue
            a, b = sets[x], sets[y]
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= percent * (len(a) + len(b) - both):
                up[rx] = ry
                out.append((x, y))
        return pd.DataFrame(out, columns=["a", "b"])

    return pairs.groupBy("task").cogroup(text.groupBy("t_task")).applyInPandas(check, "a long, b long")


def _compare(percent: int):
    """Pairs of each block of a group that are not connected and that the lower bound leaves."""
    c = (100 - percent) / (100 + percent)

    def block(pdf: pd.DataFrame, out: list) -> None:
        cells = np.stack([np.frombuffer(x, np.uint8) for x in pdf["cells"]]).astype(np.int16)
        ids, n, comp, part = (pdf[x].to_numpy() for x in ("id", "n", "comp", "part"))
        hub, same = int(pdf["hub"].iloc[0]), pdf["one"].iloc[0]
        for i in range(len(ids) - 1):
            j = np.arange(i + 1, len(ids))
            j = j[(comp[j] != comp[i]) & (np.floor(c * (n[j] + n[i]) + 1e-9) >= np.abs(n[j] - n[i]))]
            if not same:
                j = j[part[j] != part[i]]
            if not len(j):
                continue
            gap = np.abs(cells[j] - cells[i]).sum(axis=1)
            for q in j[gap <= np.floor(c * (n[j] + n[i]) + 1e-9)].tolist():
                x, y = (i, q) if ids[i] < ids[q] else (q, i)
                out.append((ids[x], ids[y], comp[x], comp[y], hub, hub))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        for _, rows in pdf.groupby(["hub", "b1", "b2"], sort=False):
            block(rows, out)
        return pd.DataFrame(out, columns=["x", "y", "cx", "cy", "gx", "gy"])

    return run


def jaccard_components(docs: DataFrame, shingle: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def signed(d: DataFrame) -> DataFrame:
        # ids travel as text: beside a null one, pandas would hold them as doubles
        got = d.select(F.col("doc_id").cast("string"), "text").mapInPandas(_sets(shingle), "doc_id string, n long, k1 long, k2 long")
        return stored(got.withColumn("doc_id", F.col("doc_id").cast("long")), "join-sets")

    sets = signed(docs)
    known = sets.where("n > 0 and doc_id is not null")
    several = known.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("lo"), F.max(F.struct("k1", "k2")).alias("hi")).where("lo <> hi")
    several = stored(several.select(F.col("doc_id").alias("m_id")), "join-several")
    if several.isEmpty():
        comp = _components_of(docs, sets, None, shingle, percent).withColumnRenamed("id", "c_id")
        out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(comp, F.col("doc_id") == F.col("c_id"), "left")
        return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))
    # ids with several texts: each text is a node of its own, linked to its id
    own = docs.join(several, F.col("doc_id") == F.col("m_id"), "left")
    own = own.select(F.when(F.col("m_id").isNotNull(), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")).alias("doc_id"), "text", "m_id")
    alias = stored(own.where("m_id is not null").select(F.col("doc_id").alias("a_id"), "m_id").distinct(), "join-aliases")
    own = own.select("doc_id", "text")
    sets = signed(own)
    comp = _components_of(own, sets, alias.select(F.col("a_id").alias("a"), F.col("m_id").alias("b")), shingle, percent)
    comp = stored(comp.join(alias, F.col("id") == F.col("a_id"), "left").select("id", "comp", F.coalesce("m_id", "id").alias("real")), "join-real")
    least = comp.groupBy(F.col("comp").alias("l_comp")).agg(F.min("real").alias("component_id"))
    comp = comp.join(least, F.col("comp") == F.col("l_comp")).select(F.col("id").alias("c_id"), "real", "component_id")
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(comp, F.col("doc_id") == F.col("c_id"), "left")
    return out.select(F.coalesce("real", "doc_id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _components_of(docs: DataFrame, sets: DataFrame, known_links: DataFrame | None, shingle: int, percent: int) -> DataFrame:
    """(id, comp) of the linked documents of ``docs``, whose ids have one text each; ``known_links``: more (a, b)."""
    known = sets.where("n > 0 and doc_id is not null")
    classes = stored(known.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("id"), F.count("*").alias("size")), "join-classes")
    again = known.select("doc_id", "k1", "k2", "n").join(classes.where("size > 1").select("k1", "k2", "n", "id"), ["k1", "k2", "n"]).where("doc_id <> id")
    copies = stored(again.select(F.col("id").alias("a"), F.col("doc_id").alias("b")), "join-copies")
    # the first document stands for its class
    rep = docs.where("doc_id is not null").join(_few(copies, "b"), F.col("doc_id") == F.col("b"), "left_anti")
    member = rep.mapInPandas(_signed(shingle, percent), "doc_id long, sigs array<long>")
    member = member.select(F.explode("sigs").alias("sig"), F.col("doc_id").alias("id"))
    member = member.withColumn("cnt", F.count("*").over(W.partitionBy("sig"))).where("cnt > 1")
    member = stored(member, "join-buckets")
    pop = member.groupBy("id").agg(F.sum("cnt").alias("pop"))
    star = F.struct("pop", (-F.col("id")).alias("m"))
    ranked = member.join(pop, "id").withColumn("star", star)
    hubs = ranked.groupBy("sig").agg(F.max("star").alias("hub"))
    # whoever shares a segment with others is in the group of that segment's most shared member
    groups = stored(member.join(hubs, "sig").select("id", "hub").distinct(), "join-groups")
    best = groups.groupBy("id").agg(F.max("hub").alias("hub")).select("id", (-F.col("hub.m")).alias("hub"))
    pairs = best.where("id <> hub").select(F.col("id").alias("x"), F.col("hub").alias("y"), F.col("id").alias("cx"), F.col("hub").alias("cy"), F.col("hub").alias("gx"), F.col("hub").alias("gy"))
    links = stored(_verify(pairs, docs, shingle, percent), "join-links")
    comp = components(links)
    left = groups.select("id", (-F.col("hub.m")).alias("hub")).join(comp, "id", "left").select("id", "hub", F.coalesce("comp", "id").alias("comp"))
    mixed = left.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("cnt")).where("lo <> hi").select("hub", "cnt")
    left = stored(left.join(mixed, "hub"), "join-open")
    left_rows = left.count()
    about = rep.join(_few(left, "id"), F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"])
    about = about.mapInPandas(_cells(shingle), "r_id long, n long, cells binary")
    parts = F.ceil(F.col("cnt") / BLOCK).cast("int")
    left = left.withColumn("part", F.pmod(F.xxhash64("id", "hub"), parts).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    left = left.withColumn("b1", F.least("part", "other")).withColumn("b2", F.greatest("part", "other")).withColumn("one", F.col("b1") == F.col("b2"))
    # many blocks are tiny: a task's group has several, about ROWS rows in all
    left = left.withColumn("group", F.pmod(F.xxhash64("hub", "b1", "b2"), F.lit(max(1, left_rows // ROWS))))
    left = left.join(about, F.col("id") == F.col("r_id")).drop("r_id")
    pairs = stored(left.groupBy("group").applyInPandas(_compare(percent), "x long, y long, cx long, cy long, gx long, gy long"), "join-left")
    more = stored(_verify(pairs, docs, shingle, percent), "join-links")
    links = links.unionByName(more).unionByName(copies)
    return components(links if known_links is None else links.unionByName(known_links))


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id (five words, 0.8).

    Rows that repeat an id and its text are one document; an id's different texts all stay
    where the id does.
    """
    c = jaccard_components(docs, shingle=5, percent=80).where("doc_id <> component_id").select(F.col("doc_id").alias("c_id")).distinct()
    ids = _few(stored(c, "near-copies"), "c_id")
    kept = docs.join(ids, docs["doc_id"] == ids["c_id"], "left_anti")
    again = stored(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("r_id")), "repeated-ids")
    if again.isEmpty():
        return kept
    several = kept.join(again, F.col("doc_id") == F.col("r_id"), "left_semi")
    one = several.groupBy("doc_id", F.xxhash64("text").alias("x"), F.md5(F.col("text").cast("binary")).alias("y")).agg(F.min(F.struct(*docs.columns)).alias("r"))
    return kept.join(again, F.col("doc_id") == F.col("r_id"), "left_anti").unionByName(one.select("r.*"))
