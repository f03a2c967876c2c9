"""Toxic spans with a linear-chain conditional random field.

Documents carry the labels, so token labels come first: features of tokens (the word, its
first three to five letters, its ending) that occur in toxic documents far above chance and
seldom elsewhere mark their tokens; near copies count once. A two-tag CRF is fitted on
windows of those labelled tokens (forward-backward gradients, Adam). Scoring runs
forward-backward over every whole text: the marginals of the toxic tag give spans with
offsets, and their peak and sum give the document's score through a logistic curve fitted
on the same training rows.

Labels come only from rows outside the held-out fold (see ``common.held_out``).
Defined results: null, empty and wordless texts get the score of a text without toxic
tokens and no spans; without toxic labels no token is marked and every score is low;
repeated rows score alike; empty tables give no rows; extra columns are ignored.
"""

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, held_out, stored, table

#: Labelled rows the lexicon and the curve are fitted on at most, and rows that give windows.
TRAIN_ROWS, WINDOW_ROWS = 20_000, 5_000
WINDOW, PER_DOC = 12, 4
CACHE = 300_000
tokens_of = re.compile(r"\w+").findall


def features(word: str) -> list[str]:
    w = word.lower()
    return [f"w{w}", f"3{w[:3]}", f"4{w[:4]}", f"5{w[:5]}", f"e{w[-3:]}", f"l{min(len(w), 12)}"]


def _sketch(words: list[str]) -> int:
    """A number that near copies share: two minima over hashes of word triples."""
    seen = [zlib.crc32("\t".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))]
    return (min(seen) << 31) ^ min((x * 2654435761) & 0xFFFFFFFF for x in seen)


def _counts(batches):
    """(feature, docs, toxic) of each batch, for words and beginnings of words."""
    for pdf in batches:
        n, t = Counter(), Counter()
        for text, y in zip(pdf["text"], pdf["y"]):
            found = {f for w in set(tokens_of(text)) for f in features(w)[:4]}
            n.update(found)
            if y:
                t.update(found)
        yield pd.DataFrame({"f": list(n), "n": list(n.values()), "t": [t[k] for k in n]})


class Model:
    """Feature weights of the toxic tag, transition weights and the document curve."""

    def __init__(self, weights: dict[str, float], bias: float, trans: np.ndarray, curve=None):
        self.weights, self.bias, self.trans, self.curve = weights, bias, trans, curve

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


class Emissions(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        e = self.model.emission(word)
        if len(word) <= 64:
            self[word] = e
        return e


def marginal_odds(seqs: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Forward-backward over sequences of emissions: odds of the toxic tag at each token.

    With two tags the normalised messages are single ratios. Sequences of like length run
    together, one array step per token.
    """
    a = np.exp(trans)
    out: list = [np.zeros(0)] * len(seqs)
    order = sorted((i for i in range(len(seqs)) if len(seqs[i])), key=lambda i: len(seqs[i]))
    start = 0
    while start < len(order):
        longest = len(seqs[order[start]])
        stop = start
        while stop < len(order) and len(seqs[order[stop]]) <= longest * 1.3 + 8 and (stop - start + 1) * len(seqs[order[stop]]) <= 4_000_000:
            stop += 1
        group = order[start:max(stop, start + 1)]
        start += len(group)
        lens = np.array([len(seqs[i]) for i in group])
        top = int(lens.max())
        e = np.zeros((top, len(group)))
        for k, i in enumerate(group):
            e[: lens[k], k] = np.exp(np.clip(seqs[i], -30, 30))
        r = np.empty_like(e)
        r[0] = e[0]
        for t in range(1, top):
            r[t] = e[t] * (a[0, 1] + r[t - 1] * a[1, 1]) / (a[0, 0] + r[t - 1] * a[1, 0])
        q = np.ones(len(group))
        for t in range(top - 2, -1, -1):
            z = e[t + 1] * q
            q = np.where(t + 1 < lens, (a[1, 0] + a[1, 1] * z) / (a[0, 0] + a[0, 1] * z), 1.0)
            r[t] *= q
        for k, i in enumerate(group):
            out[i] = r[: lens[k], k]
    return out


def fit_crf(windows: list[list[str]], tags: list[list[int]], weight: list[float], steps: int = 100, l2: float = 1e-4) -> Model:
    """Maximum likelihood by Adam over windows of equal length (short ones are left out)."""
    keep = [i for i, w in enumerate(windows) if len(w) == WINDOW]
    if not keep:
        return Model({}, -6.0, np.array([[0.0, -2.0], [0.0, 0.0]]))
    seen = Counter(f for i in keep for w in set(windows[i]) for f in features(w))
    index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= 2))}
    void = len(index)
    x = np.array([[[index.get(f, void) for f in features(w)] for w in windows[i]] for i in keep])
    y = np.array([tags[i] for i in keep])
    s = np.array([weight[i] for i in keep])
    s = s / s.sum() * len(s)
    theta = np.zeros(void + 6)  # features, void, bias, four transitions
    theta[void + 1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n, length = y.shape
    flat = x.ravel()
    real = np.stack([[((y[:, :-1] == i) & (y[:, 1:] == j)).sum(axis=1) for j in (0, 1)] for i in (0, 1)]).transpose(2, 0, 1)
    for step in range(1, steps + 1):
        w = theta.copy()
        w[void] = 0
        e = np.exp(np.clip(w[x].sum(axis=2) + theta[void + 1], -30, 30))
        a = np.exp(theta[void + 2:].reshape(2, 2))
        f = np.empty((length, n, 2))
        f[0, :, 0], f[0, :, 1] = 1, e[:, 0]
        f[0] /= f[0].sum(axis=1, keepdims=True)
        for t in range(1, length):
            f[t] = f[t - 1] @ a
            f[t, :, 1] *= e[:, t]
            f[t] /= f[t].sum(axis=1, keepdims=True)
        b = np.ones((n, 2))
        p1 = np.empty((n, length))
        pair = np.zeros((n, 2, 2))
        for t in range(length - 1, -1, -1):
            g = f[t] * b
            p1[:, t] = g[:, 1] / g.sum(axis=1)
            if t:
                z = b * np.stack([np.ones(n), e[:, t]], axis=1)
                xi = f[t - 1][:, :, None] * a[None] * z[:, None, :]
                pair += xi / xi.sum(axis=(1, 2), keepdims=True)
                b = z @ a.T
                b /= b.sum(axis=1, keepdims=True)
        err = (p1 - y) * s[:, None]
        grad = np.zeros_like(theta)
        grad[: void + 1] = np.bincount(flat, np.repeat(err.ravel(), x.shape[2]), void + 1)
        grad[void] = 0
        grad[void + 1] = err.sum()
        grad[void + 2:] = ((pair - real) * s[:, None, None]).sum(axis=0).ravel()
        grad = grad / n + l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta -= 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model({f: float(theta[k]) for f, k in index.items() if abs(theta[k]) > 0.02}, float(theta[void + 1]), theta[void + 2:].reshape(2, 2))


def _peaks(texts, emit: Emissions, trans: np.ndarray):
    """What the curve reads of each text, and the odds of its tokens.

    Log odds of the most toxic token, log of the expected number of toxic tokens, log of the
    tokens more likely toxic than not, log of all tokens.
    """
    seqs = [np.fromiter(map(emit.__getitem__, tokens_of(t)), dtype=float) for t in texts]
    odds = marginal_odds(seqs, trans)
    x = np.zeros((len(odds), 4))
    x[:, :2] = -12.0
    for k, o in enumerate(odds):
        if len(o):
            x[k] = np.log(o.max() + 1e-12), np.log((o / (1 + o)).sum() + 1e-6), np.log1p((o >= 1).sum()), np.log1p(len(o))
    return np.clip(x, -12, 12), odds


def lexicon(train: DataFrame) -> set[str]:
    """Features whose documents are mostly toxic, far above chance."""
    total = train.agg(F.count("*").alias("n"), F.sum("y").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    if not t or t == n:
        return set()
    c = train.mapInPandas(_counts, "f string, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    p0, q = F.lit(t / n), F.col("t") / F.col("n")
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p0))).otherwise(0.0)
    kl = F.col("n") * (q * F.log(q / p0) + rest)
    c = c.where(F.col("t") >= 3).withColumn("kl", kl).withColumn("q", q)
    c = stored(c, "toxic-features")
    # chance of so many toxic documents is under exp(-kl): of all features tried, less than one passes by chance
    least = math.log(max(1, c.count())) + 1
    return {r["f"] for r in c.where((F.col("q") >= 0.6) & (F.col("kl") >= least)).orderBy(F.col("kl").desc(), "f").limit(5000).select("f").collect()}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most about ``rows`` labelled documents outside the held-out fold."""
    lab = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    lab = bounded_sample(lab.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")), "doc_id", rows)

    @F.pandas_udf("long")
    def sketch(texts: pd.Series) -> pd.Series:
        return pd.Series([_sketch(tokens_of(t)) for t in texts], dtype="int64")

    got = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(lab), "doc_id")
    got = stored(got.withColumn("s", sketch("text")).dropDuplicates(["s", "y"]).select("doc_id", "text", "y"), "toxic-train")
    lex = lexicon(got)

    def windows(batches):
        for pdf in batches:
            out = []
            for i, text, y in zip(pdf["doc_id"], pdf["text"], pdf["y"]):
                words = tokens_of(text)
                if len(words) < WINDOW:
                    continue
                tag = [int(y and not lex.isdisjoint(features(w)[:4])) for w in words]
                rng = np.random.default_rng(int(i) & 0x7FFFFFFF)
                at = [k for k, v in enumerate(tag) if v]
                at = [at[k] for k in rng.permutation(len(at))[:PER_DOC]]
                for k in at + rng.integers(0, len(words), PER_DOC).tolist():
                    b = int(np.clip(k - rng.integers(0, WINDOW), 0, len(words) - WINDOW))
                    # windows drawn at random stand for the whole text, the others for their tokens
                    w = 1.0 if any(tag[b:b + WINDOW]) else max(1.0, len(words) / WINDOW / PER_DOC)
                    out.append((words[b:b + WINDOW], tag[b:b + WINDOW], w))
            yield pd.DataFrame(out, columns=["w", "t", "s"])

    few = bounded_sample(got.where("y = 0"), "doc_id", WINDOW_ROWS // 2).unionByName(bounded_sample(got.where("y = 1"), "doc_id", WINDOW_ROWS // 2))
    win = few.mapInPandas(windows, "w array<string>, t array<int>, s double").toPandas()
    model = fit_crf([list(w) for w in win["w"]], [list(t) for t in win["t"]], win["s"].tolist())

    @F.pandas_udf("array<double>")
    def peaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        emit = Emissions(model)
        for texts in batches:
            yield pd.Series(list(_peaks(texts, emit, model.trans)[0]), dtype=object)

    seen = got.select("y", peaks("text").alias("x")).toPandas()
    model.curve = _curve(np.array(seen["x"].tolist(), dtype=float).reshape(len(seen), 4), seen["y"].to_numpy(dtype=float))
    return model


def _curve(x: np.ndarray, y: np.ndarray, hold: float = 0.05, steps: int = 100) -> np.ndarray:
    """Logistic regression on what ``_peaks`` reads, lightly held to small slopes.

    Newton steps, each halved until the loss falls, up to a flat gradient; where the fit
    is no better than one score for all (the label share), that one stands.
    """
    if len(y) == 0 or y.max() == 0:
        return np.array([0.5, 0.0, 0.0, 0.0, -3.0])
    z = np.column_stack([x, np.ones(len(x))])
    ridge = hold * np.array([1.0, 1.0, 1.0, 1.0, 0.01])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    beta = np.array([0.0, 0.0, 0.0, 0.0, np.log(share / (1 - share))])

    def loss(b: np.ndarray) -> float:
        u = z @ b
        return float((np.logaddexp(0, u) - y * u).sum() + 0.5 * (ridge * b * b).sum())

    now = constant = loss(beta)
    best = beta
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (p - y) + ridge * beta
        if np.abs(slope).max() < 1e-6 * len(y):
            break
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), slope)
        size = 1.0
        while size > 1e-8 and loss(beta - size * step) >= now:
            size /= 2
        if size <= 1e-8:
            break
        beta = beta - size * step
        now = loss(beta)
        best = beta if now < constant else best
    return best


def _score(x: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ curve[:4] + curve[4], -30, 30)))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, spans (begin and end in code points)."""

    @F.pandas_udf("score double, spans array<struct<begin:int,end:int>>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emit = Emissions(model)
        for texts in batches:
            x, odds = _peaks(texts, emit, model.trans)
            spans = []
            for text, o in zip(texts, odds):
                own: list[dict] = []
                if len(o) and o.max() >= 1:
                    last = -2
                    for k, m in enumerate(re.finditer(r"\w+", text)):
                        if o[k] >= 1:
                            if own and last == k - 1:
                                own[-1]["end"] = m.end()
                            else:
                                own.append({"begin": m.start(), "end": m.end()})
                            last = k
                spans.append(own)
            yield pd.DataFrame({"score": _score(x, model.curve), "spans": spans})

    d = docs.withColumn("_tag", tag(F.coalesce("text", F.lit(""))))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_tag.score").alias("score"),
                    (F.col("_tag.score") >= threshold).cast("int").alias("predicted"), F.col("_tag.spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Keep the documents whose score is under the threshold."""
    model = train(docs, table(spark, sf_dir, "labels"))

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        emit = Emissions(model)
        for texts in batches:
            yield pd.Series(_score(_peaks(texts, emit, model.trans)[0], model.curve) < threshold)

    return docs.where(clean(F.coalesce("text", F.lit(""))))
