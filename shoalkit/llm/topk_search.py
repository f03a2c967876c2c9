"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of terms (component numbers) with integer weights; components
that are 0 are no terms. Rows are packed where they stand into blocks of postings: a
block lists, term by term, the rows that have it and their weights. Each query row
scatters its weighted postings into a dense array of scores, a column a query and a row a
candidate, one term after the other; a partition selection takes each query's best of a
block, a cell merges those of its blocks, and a window over (query, cell) bests gives the
answer. No candidate is left out by a bound or a sample.

Queries are a stated set (ids divisible by ``every``) and meet all rows in cells: a slice
of index blocks (about ``SLICE`` rows) by a group of queries (about ``GROUP``), both dealt
by hash, so a cell's work and memory don't depend on ids, repeated rows or equal vectors.
Rows moved: the index once a group, the queries once a slice, ``k`` bests a query and slice.

Defined results: vectors that are null or hold null or non-finite components take no part;
absent components (shorter or empty vectors) count as 0; a candidate without id takes part
and comes last among equal scores; rows that share an id are rows of their own, each a
query where the id says so, and only a query's own row is not its candidate; with fewer
than ``k`` candidates all are returned; floors outside the range of long are held at its
ends and sums wrap as long arithmetic does; empty tables give no rows; extra columns are
ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, whole_vectors

#: Rows and components of an index block, rows of a slice, queries of a group and of a tile.
ROWS, VALUES, SLICE, GROUP, TILE = 4096, 1 << 20, 8192, 4096, 64
INDEX = "block long, n int, ids array<long>, terms binary, starts binary, rows binary, weights binary"


def postings(flat: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, starts, rows, weights) of rows laid end to end: those of terms[t] are starts[t]:starts[t + 1]."""
    row = np.repeat(np.arange(len(lens)), lens)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    some = np.flatnonzero(flat)
    some = some[np.argsort(term[some], kind="stable")]
    terms, starts = np.unique(term[some], return_index=True)
    return terms, np.append(starts, len(some)), row[some], flat[some]


def _index(batches):
    """Blocks of postings, in the order rows come; a block's number holds its partition's."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, v = batch.column("vec_id"), batch.column("v")
        lens = np.diff(v.offsets.to_numpy())
        at = 0
        while at < len(lens):
            room = int(np.searchsorted(np.cumsum(lens[at:at + ROWS]), VALUES, side="right"))
            n = max(1, min(room, ROWS, len(lens) - at))
            flat = v.slice(at, n).flatten().to_numpy(zero_copy_only=False)
            terms, starts, rows, weights = postings(flat, lens[at:at + n])
            yield pa.RecordBatch.from_pydict({
                "block": [(part << 32) + made], "n": pa.array([n], pa.int32()), "ids": pa.array([ids.slice(at, n).to_pylist()], pa.list_(pa.int64())),
                "terms": [terms.astype(np.int32).tobytes()], "starts": [starts.astype(np.int32).tobytes()],
                "rows": [rows.astype(np.int32).tobytes()], "weights": [weights.astype(np.int64).tobytes()]})
            made, at = made + 1, at + n


def _block(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["terms"], np.int32), np.frombuffer(row["starts"], np.int32),
            np.frombuffer(row["rows"], np.int32), np.frombuffer(row["weights"], np.int64))


def _queries(every: int):
    """The rows of index blocks that are queries: (own_block, own_row, query_id, terms, weights)."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                mine = [k for k, i in enumerate(r["ids"]) if i is not None and i % every == 0]
                terms, starts, rows, weights = _block(r)
                asked = np.isin(rows, mine)
                term = np.repeat(terms, np.diff(starts))[asked]
                row, weight = rows[asked], weights[asked]
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.append(mine, ROWS + 1))
                term, weight = term[order], weight[order]
                yield pa.RecordBatch.from_pydict({
                    "own_block": pa.array([r["block"]] * len(mine), pa.int64()), "own_row": pa.array(mine, pa.int32()),
                    "query_id": pa.array([r["ids"][k] for k in mine], pa.int64()),
                    "terms": pa.array([term[a:b] for a, b in zip(cut, cut[1:])], pa.list_(pa.int32())),
                    "weights": pa.array([weight[a:b] for a, b in zip(cut, cut[1:])], pa.list_(pa.int64()))})
    return run


def accumulate(index, n: int, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores (candidate, query) of a block of ``n`` rows: every term's postings scattered, term by term."""
    terms, starts, rows, weights = index
    scores = np.zeros((n, len(queries)), dtype=np.int64)
    term = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in queries]])
    query = np.repeat(np.arange(len(queries)), [len(t) for t, _ in queries])
    weight = np.concatenate([np.zeros(0, np.int64), *[w for _, w in queries]])
    order = np.argsort(term, kind="stable")
    term, query, weight = term[order], query[order], weight[order]
    head = np.flatnonzero(np.append(True, np.diff(term) != 0)[: len(term)])
    for a, b in zip(head, np.append(head[1:], len(term))):
        at = np.searchsorted(terms, term[a])
        if at == len(terms) or terms[at] != term[a]:
            continue
        p = slice(starts[at], starts[at + 1])
        who, what = rows[p], weights[p, None] * weight[None, a:b]
        if b - a < len(queries):
            scores[who[:, None], query[None, a:b]] += what
        elif len(who) < n:
            scores[who] += what
        else:
            scores += what
    return scores


def best(scores: np.ndarray, ids: np.ndarray, blank: np.ndarray, k: int, but: int = -1) -> np.ndarray:
    """The k largest scores' places (all if fewer), ties to smaller ids, without place ``but``."""
    n = len(scores)
    most = k + (but >= 0)
    at = np.arange(n) if n <= most else np.flatnonzero(scores >= np.partition(scores, n - most)[n - most])
    at = at[at != but]
    return at[np.lexsort((ids[at], blank[at], ~scores[at]))][:k]


def _cell(k: int):
    """One slice of the index by one group of queries: each query's best of the slice."""
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        q = list(zip(queries["terms"], queries["weights"]))
        own = list(zip(queries["own_block"], queries["own_row"]))
        found: list[list] = [[] for _ in q]
        for r in index.to_dict("records"):
            block = _block(r)
            blank = pd.isna(pd.Series(r["ids"], dtype=object)).to_numpy(dtype=bool)
            ids = np.array([0 if b else i for i, b in zip(r["ids"], blank)], dtype=np.int64)
            for t in range(0, len(q), TILE):
                scores = np.ascontiguousarray(accumulate(block, r["n"], q[t:t + TILE]).T)
                for j, s in enumerate(scores, t):
                    at = best(s, ids, blank, k, own[j][1] if own[j][0] == r["block"] else -1)
                    found[j].append((s[at], ids[at], blank[at]))
        out = []
        for (block, row), i, f in zip(own, queries["query_id"], found if len(index) else []):
            s, ids, blank = (np.concatenate(x) for x in zip(*f))
            at = best(s, ids, blank, k)
            out += [(block, row, i, None if b else v, x) for b, v, x in zip(blank[at].tolist(), ids[at].tolist(), s[at].tolist())]
        names = ["own_block", "own_row", "query_id", "vec_id", "score"]
        return pd.DataFrame(out, columns=names).astype({"vec_id": "Int64"})
    return run


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Per query row and rank: query_id, rank, vec_id, score. ``vectors``: vec_id long, v array<long>."""
    index = stored(vectors.select("vec_id", "v").mapInArrow(_index, INDEX), "topk-index")
    queries = index.mapInArrow(_queries(every), "own_block long, own_row int, query_id long, terms array<int>, weights array<long>")
    queries = stored(queries, "topk-queries")
    groups, slices = queries.count() // GROUP + 1, (index.agg(F.sum("n").alias("n")).first()["n"] or 0) // SLICE + 1
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
    index = index.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")).withColumn("group", each(groups))
    queries = queries.withColumn("group", F.pmod(F.xxhash64("own_block", "own_row"), F.lit(groups)).cast("int")).withColumn("slice", each(slices))
    found = index.groupBy("slice", "group").cogroup(queries.groupBy("slice", "group"))
    found = found.applyInPandas(_cell(k), "own_block long, own_row int, query_id long, vec_id long, score long")
    order = Window.partitionBy("own_block", "own_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(whole_vectors(table(spark, sf_dir, "embeddings"), "embedding", 256))


ORACLE_OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, coalesce(score, 0) AS score
FROM s
WINDOW w AS (PARTITION BY r ORDER BY coalesce(score, 0) DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 5
"""
