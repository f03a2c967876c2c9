"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text (character classes, word and line repetition) are binned by
quantiles of a bounded labelled sample; trees grow level by level from gradient histograms
(one bincount per level). Each tree is a complete binary tree in flat arrays, so scoring
walks all rows of a batch with one array step per level and tree.

Labels come only from rows outside the held-out fold (see ``common.held_out``).
Defined results: null and empty texts have all statistics 0 and get a score like any other;
without labels of both classes the score is the label share seen (0.5 without any);
repeated rows score alike; a labelled id with several labels counts with the highest;
empty tables give no rows; extra columns are ignored.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, held_out, table

#: Labelled rows the model is fitted on at most (about; picked by a hash of the id).
TRAIN_ROWS = 20_000
SIGNS = b".,;:!?'\"()|#$%&*<>/\\=+-_@{}[]~`^"


def statistics(text: str) -> list[float]:
    """The statistics of one text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(raw)
    if n == 0:
        return [0.0] * (len(SIGNS) + 24)
    c = np.bincount(raw, minlength=256)
    out = [np.log1p(n), c[65:91].sum() / n, c[97:123].sum() / n, c[48:58].sum() / n, c[32] / n, c[10] / n,
           c[:32].sum() / n, c[128:].sum() / n, c[SIGNS_AT].sum() / n]
    out += (c[SIGNS_AT] / n).tolist()
    words = text.split()
    k = len(words)
    count = Counter(words)
    top = count.most_common(2)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    m = len(lines)
    lens = [len(w) for w in words]
    out += [np.log1p(k), n / max(k, 1), len(count) / max(k, 1), pairs / max(k - 1, 1),
            top[0][1] / k if k else 0, top[1][1] / k if len(top) > 1 else 0, max(lens, default=0),
            sum(x <= 3 for x in lens) / max(k, 1), sum(x >= 12 for x in lens) / max(k, 1),
            sum(map(str.isupper, words)) / max(k, 1), sum(map(str.istitle, words)) / max(k, 1), sum(map(str.isalpha, words)) / max(k, 1),
            m, len(set(lines)) / max(m, 1), n / max(m, 1)]
    return [float(x) for x in out]


SIGNS_AT = np.frombuffer(SIGNS, dtype=np.uint8)


class Trees:
    """Boosted trees of one depth in flat arrays: node i has children 2i+1 and 2i+2."""

    def __init__(self, base: float, feature=None, threshold=None, value=None, depth: int = 0):
        self.base, self.feature, self.threshold, self.value, self.depth = base, feature, threshold, value, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(0 if self.feature is None else len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t][node]] > self.threshold[t][node])
            total += self.value[t][node - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 48, least: int = 8, l2: float = 1.0) -> Trees:
    """Fit boosted trees on statistics ``x`` and labels ``y`` (logistic loss)."""
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    base = np.log(share / (1 - share))
    if len(y) < 2 * least or y.min() == y.max():
        return Trees(base)
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    flat = code + np.arange(m) * bins  # value > edges[b] exactly when code > b
    score = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        feat = np.zeros(2 ** depth - 1, dtype=np.int64)
        thr = np.full(2 ** depth - 1, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            at = ((node - first)[:, None] * (m * bins) + flat).ravel()
            shape = (width, m, bins)
            hist = [np.bincount(at, np.repeat(v, m), width * m * bins).reshape(shape).cumsum(axis=2) for v in (g, h, np.ones(n))]
            (gl, hl, nl), (gt, ht, nt) = hist, [v[:, :, -1:] for v in hist]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(nl < least) | (nt - nl < least)] = -1
            for j, e in enumerate(edges):
                gain[:, j, len(e):] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6:
                    feat[first + k], thr[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feat[node]] > thr[node])
        leaf = node - (2 ** depth - 1)
        value = -rate * np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + l2)
        score += value[leaf]
        features.append(feat), thresholds.append(thr), values.append(value)
    return Trees(base, features, thresholds, values, depth)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most about ``rows`` labelled documents outside the held-out fold."""
    @F.pandas_udf("array<double>")
    def statistics_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    lab = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    lab = bounded_sample(lab.groupBy("doc_id").agg(F.max(label).alias("y")), "doc_id", rows)
    got = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")  # `rows` ids at most
    got = got.select(statistics_udf(F.coalesce("text", F.lit(""))).alias("x"), "y").toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(statistics("")))
    return fit(x, got["y"].to_numpy(dtype=float))


def score_documents(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), -1)))

    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.coalesce("text", F.lit(""))).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
