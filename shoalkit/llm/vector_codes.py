"""Product-quantised vector codes: Lloyd rounds over cover trees.

Vectors of integers are cut into equal parts; each part position has a codebook. Rows are
packed where they stand into blocks, and a block keeps one cover tree a part: a node holds
a point, the radius of all points under it and the run of points under it; the points lie
in tree order with cumulative sums, so a node's points and their sum are two reads. A round
walks the trees level by level, all nodes of a level at once, each with the entries that may
still be nearest: an entry whose distance less the radius exceeds the nearest's plus the
radius goes (triangle inequality). A node with one entry left gives it its whole subtree;
only ambiguous nodes descend, at the end to exact integer comparisons of their points.
Partitions hand on sums and counts, added up in Spark; the driver holds the codebooks only.

Distances for pruning are doubles with a margin above their rounding, all that decides is
integer arithmetic: the codes equal those of comparing every point with every entry.

Defined results: vectors that are null or hold null or non-finite components are dropped;
fewer kept rows than entries give so many entries; rows without id come last, and rows that
share an id are ordered by vector, where the first codebook is chosen; the part's width is
an eighth of the longest vector's length, rounded up, and shorter vectors end in zeros;
integers are held at +-2^30/sqrt(components) (2^27 for 64), where all squared distances are
exact; ``label_error`` sums are held at the largest long; rows with equal vectors have equal
codes; an empty table gives no rows; extra columns are ignored.
"""

import hashlib
import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, whole_vectors

#: Rows and components of a block; points of a node that is not divided further.
ROWS, VALUES, LEAF = 4096, 1 << 21, 16
FAR = np.iinfo(np.int64).max


class CoverTree:
    """Points in tree order, and nodes level by level: run of points, centre, radius, children."""

    def __init__(self, perm, points, low, high, centre, radius, child, last):
        self.perm, self.points, self.low, self.high = perm, points, low, high
        self.centre, self.radius, self.child, self.last = centre, radius, child, last
        self.total = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
        np.cumsum(points, axis=0, out=self.total[1:])

    @classmethod
    def of(cls, x: np.ndarray) -> "CoverTree":
        """Nodes cover their points by balls of half their radius, each around a point that no other covers."""
        perm = np.arange(len(x))
        low, high, centre, radius, child, last = [0], [len(x)], [0], [], [], []
        node = 0
        while node < len(low):
            a, b = low[node], high[node]
            own = perm[a:b]
            far = ((x[own] - x[centre[node]]) ** 2).sum(axis=1)
            most = int(far.max()) if len(far) else 0
            radius.append(math.sqrt(most) * (1 + 1e-9))
            child.append(len(low))
            if most and b - a > LEAF:
                ball = most // 4
                of = np.zeros(len(own), dtype=np.int64)
                rest, chosen = np.flatnonzero(far > ball), [centre[node]]
                while len(rest):
                    p = own[rest[far[rest].argmax()]]
                    near = ((x[own[rest]] - x[p]) ** 2).sum(axis=1) <= ball
                    of[rest[near]] = len(chosen)
                    chosen.append(int(p))
                    rest = rest[~near]
                perm[a:b] = own[np.argsort(of, kind="stable")]
                ends = a + np.cumsum(np.bincount(of, minlength=len(chosen)))
                low += [a, *ends[:-1].tolist()]
                high += ends.tolist()
                centre += chosen
            last.append(len(low))
            node += 1
        place = np.empty(len(x), dtype=np.int64)
        place[perm] = np.arange(len(x))
        ints = [np.array(v, dtype=np.int32) for v in (low, high, place[centre] if len(x) else [0], child, last)]
        return cls(perm.astype(np.int32), x[perm], *ints[:3], np.array(radius), *ints[3:])

    def arrays(self) -> list[np.ndarray]:
        return [self.perm, self.points, self.low, self.high, self.centre, self.radius, self.child, self.last]

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(entry of each point in tree order, sums by entry, counts by entry, points compared singly)."""
        code = np.zeros(len(self.points), dtype=np.int64)
        sums, counts = np.zeros_like(book), np.zeros(len(book), dtype=np.int64)
        if not len(self.points) or not len(book):
            return code, sums, counts, 0
        node, may, single = np.zeros(1, dtype=np.int64), np.ones((1, len(book)), bool), 0
        while len(node):
            d2 = distances(self.points[self.centre[node]], book)
            d2[~may] = FAR
            d = np.sqrt(d2.astype(float))
            r = self.radius[node][:, None]
            least = d.min(axis=1, keepdims=True)
            may = may & (d - r <= least + r + 1e-9 * (d + r))
            done = (may.sum(axis=1) == 1) | (self.radius[node] == 0)
            got = d2[done].argmin(axis=1)  # the nearest entry, of several the first
            a, b = self.low[node[done]], self.high[node[done]]
            np.add.at(sums, got, self.total[b] - self.total[a])
            counts += np.bincount(got, b - a, len(book)).astype(np.int64)
            code[runs(a, b)] = np.repeat(got, b - a)
            node, may = node[~done], may[~done]
            end = self.child[node] == self.last[node]
            if end.any():
                a, b = self.low[node[end]], self.high[node[end]]
                at, allowed = runs(a, b), np.repeat(may[end], b - a, axis=0)
                for k in range(0, len(at), 1 << 14):
                    some = at[k:k + (1 << 14)]
                    d2 = distances(self.points[some], book)
                    d2[~allowed[k:k + (1 << 14)]] = FAR
                    code[some] = d2.argmin(axis=1)
                np.add.at(sums, code[at], self.points[at])
                counts += np.bincount(code[at], minlength=len(book))
                single += len(at)
                node, may = node[~end], may[~end]
            a, b = self.child[node], self.last[node]
            node, may = runs(a, b), np.repeat(may, b - a, axis=0)
        return code, sums, counts, single


def runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All numbers of the runs a[i]:b[i], one after the other."""
    n = (b - a).astype(np.int64)
    return np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances (point, entry), exact."""
    out = np.empty((len(x), len(book)), dtype=np.int64)
    for k, entry in enumerate(book):
        out[:, k] = ((x - entry) ** 2).sum(axis=1)
    return out


def bound(width: int) -> int:
    """Integers up to here have squared distances over ``width`` components within 63 bits."""
    return math.isqrt((1 << 60) // max(1, width))


def _pack(trees: list[CoverTree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, *[a for t in trees for a in t.arrays()])
    return out.getvalue()


def _unpack(data: bytes) -> list[CoverTree]:
    with np.load(io.BytesIO(data)) as z:
        arrays = [z[f"arr_{k}"] for k in range(len(z.files))]
    return [CoverTree(*arrays[k:k + 8]) for k in range(0, len(arrays), 8)]


def _cut(values: np.ndarray, lens: np.ndarray, parts: int, width: int) -> list[np.ndarray]:
    """A block's vectors as one array (row, component) a part, zeros after their ends."""
    whole = np.zeros((len(lens), parts * width), dtype=np.int64)
    at = np.repeat(np.arange(len(lens)) * (parts * width) - (np.cumsum(lens) - lens), lens) + np.arange(len(values))
    whole.ravel()[at] = np.clip(values, -bound(parts * width), bound(parts * width))
    return [np.ascontiguousarray(whole[:, p * width:(p + 1) * width]) for p in range(parts)]


def _grow(parts: int, width: int):
    """Blocks of rows with a cover tree a part."""
    def run(batches):
        for batch in batches:
            v = batch.column("v")
            step = max(1, min(ROWS, VALUES // max(1, parts * width)))
            for at in range(0, batch.num_rows, step):
                own = v.slice(at, step)
                x = _cut(own.flatten().to_numpy(zero_copy_only=False), np.diff(own.offsets.to_numpy()), parts, width)
                one = lambda c: pa.ListArray.from_arrays([0, len(own)], batch.column(c).slice(at, step))
                yield pa.RecordBatch.from_arrays([one("vec_id"), one("label"), pa.array([_pack([CoverTree.of(y) for y in x])])], ["ids", "labels", "trees"])
    return run


def _sums(books: list[np.ndarray]):
    """A partition's (sums and counts by part, entry) under the codebooks, as one array."""
    def run(batches):
        total = np.zeros((len(books), len(books[0]), books[0].shape[1] + 1), dtype=np.int64)
        for batch in batches:
            for data in batch.column("trees"):
                for p, (tree, book) in enumerate(zip(_unpack(data.as_py()), books)):
                    _, sums, counts, _ = tree.assign(book)
                    total[p, :, :-1] += sums
                    total[p, :, -1] += counts
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.ravel()], pa.list_(pa.int64()))})
    return run


def _codes(books: list[np.ndarray]):
    """(vec_id, label, code, error) of every row."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids").slice(k, 1).flatten()
                code, error = np.zeros((len(ids), len(books)), dtype=np.uint8), np.zeros(len(ids), dtype=np.int64)
                for p, (tree, book) in enumerate(zip(_unpack(batch.column("trees")[k].as_py()), books)):
                    own = tree.assign(book)[0]
                    code[tree.perm, p] = own
                    error[tree.perm] += ((tree.points - book[own]) ** 2).sum(axis=1)
                text = [row.tobytes().hex() for row in code]
                yield pa.RecordBatch.from_arrays([ids, batch.column("labels").slice(k, 1).flatten(), pa.array(text), pa.array(error)], ["vec_id", "label", "code", "error"])
    return run


def fit(trees: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """The codebooks after ``rounds`` Lloyd rounds over all blocks."""
    shape = (len(books), len(books[0]), books[0].shape[1] + 1)
    for _ in range(rounds):
        got = trees.mapInArrow(_sums(books), "total array<long>").select(F.posexplode("total").alias("at", "x"))
        total = np.zeros(math.prod(shape), dtype=np.int64)
        for r in got.groupBy("at").agg(F.sum("x").alias("x")).collect():  # a number an entry's component
            total[r["at"]] = r["x"]
        total = total.reshape(shape)
        n = total[:, :, -1:]
        books = [np.where(n[p] > 0, total[p, :, :-1] // np.maximum(n[p], 1), book) for p, book in enumerate(books)]
    return books


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """Per row: vec_id, label, code, error, label_error, codebooks_sha256. ``vectors``: vec_id, label, v array<long>."""
    if not 0 < entries <= 256:
        raise ValueError("a code's index has one byte")
    v = vectors.select("vec_id", "label", "v")
    width = -(-(v.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0) // parts)
    first = v.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    flat = np.array([x for r in first for x in r["v"]], dtype=np.int64)
    books = _cut(flat, np.array([len(r["v"]) for r in first], dtype=np.int64), parts, width)
    kind = v.schema["label"].dataType.simpleString()
    trees = stored(v.mapInArrow(_grow(parts, width), f"ids array<long>, labels array<{kind}>, trees binary"), "code-trees")
    books = fit(trees, books, rounds)
    sha = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    rows = stored(trees.mapInArrow(_codes(books), f"vec_id long, label {kind}, code string, error long"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(int(FAR)).cast("decimal(38,0)")).cast("long")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    rows = rows.join(by_label, rows["label"].eqNullSafe(by_label["of"]), "left")
    return rows.select("vec_id", "label", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(whole_vectors(table(spark, sf_dir, "embeddings"), "embedding", 4096)).drop("label")


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds as a chain of common table expressions, every part against every entry."""
    floor = "CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END"  # // cuts towards zero
    sql = [f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(v)) // {parts} AS w FROM v),
p AS (SELECT r, p, list_slice(v, p * w + 1, p * w + w) AS x FROM v, w, (SELECT unnest(range({parts})) AS p)),
k AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM v QUALIFY e < {entries}),
c0 AS (SELECT p, e, x AS c FROM k JOIN p USING (r))"""]
    for i in range(rounds + 1):
        sql.append(f"""
d{i} AS (SELECT r, p.p, x, e, c, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d FROM p JOIN c{i} ON c{i}.p = p.p),
a{i} AS MATERIALIZED (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if i < rounds:
            sql.append(f"""
s{i} AS (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, w + 1)) AS i FROM w) GROUP BY p, e, i),
m{i} AS (SELECT p, e, list({floor} ORDER BY i) AS c FROM s{i} GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT c{i}.p, c{i}.e, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON m{i}.p = c{i}.p AND m{i}.e = c{i}.e)""")
    return ",".join(sql) + f""",
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}),
o AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN o USING (r), h
"""


ORACLE_OP13 = _oracle()
