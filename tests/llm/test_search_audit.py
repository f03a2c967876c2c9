"""Exact search, filter audit and vector codes on small hostile tables, against brute force."""

import hashlib
import json
import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalkit.llm import ORACLE, QUERIES, filter_audit, topk_search, vector_codes
from shoalkit.llm.common import whole_vectors
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, v string, n int, block string, slice string, `group` string, terms string"


@pytest.mark.parametrize("key", ["op11_topk_search", "op12_filter_audit", "op13_vector_codes"])
def test_new_queries_match_sql(spark, duck, key):
    got, want = QUERIES[key](spark, SF).toPandas(), duck(SF, ORACLE[key])
    assert digest(got)[0] == digest(want)[0]
    assert digest(got)[2] == digest(want)[2]


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, y, *["x", 1, "x", "x", "x", "x"]) for i, x, y in rows], VECTORS)


def hostile(width=16, n=140, seed=3):
    r = random.Random(seed)
    some = lambda: [r.choice([0.0, r.gauss(0, 0.3)]) for _ in range(width)]
    rows = [(i, some(), r.choice([0, 1, None])) for i in range(n)]
    same = some()
    rows += [(n + i, same, 0) for i in range(40)]  # copies: ties everywhere
    rows += [(50, some(), 1), (50, rows[50][1], 1), (None, some(), 2), (None, same, None)]
    rows += [(1000, None, 0), (1001, [0.1] * (width - 1) + [None], 0), (1050, [float("nan")] * width, 0), (1100, [float("inf")] * width, None)]
    rows += [(1150, [], 0), (1151, [0.5, -0.25], 0), (1200, [0.0] * width, 0), (-50, [-0.001] * width, 0)]
    return rows


def whole(rows, factor):
    """(id, integers, label) of the rows that take part; floats as the table holds them."""
    out = []
    for i, x, y in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            out.append((i, [math.floor(factor * float(np.float32(c))) for c in x], y))
    return out


def test_search_equals_brute_force(spark):
    rows = hostile()
    got = topk_search.search(whole_vectors(vectors(spark, rows), "embedding", 256)).collect()
    kept = whole(rows, 256)
    want = []
    for a, (q, x, _) in enumerate(kept):
        if q is not None and q % 50 == 0:
            scores = [(-sum(s * t for s, t in zip(x, y)), i is None, i) for b, (i, y, _) in enumerate(kept) if a != b]
            want += [(q, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda z: (z[0], z[1], z[2] or 0))[:5])]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_search_same_in_any_blocks(spark, monkeypatch):
    """Many small cells, one large one and three partitions give the same rows."""
    v = whole_vectors(vectors(spark, hostile(n=300)), "embedding", 256).where("vec_id is not null").dropDuplicates(["vec_id"])
    want = sorted(map(tuple, topk_search.search(v.coalesce(1)).collect()))
    for name, value in (("SLICE", 7), ("GROUP", 2)):
        monkeypatch.setattr(topk_search, name, value)
    assert sorted(map(tuple, topk_search.search(v.repartition(3)).collect())) == want


def test_accumulate_sparse_terms():
    """Rows with few terms of many, more than a block's vocabulary."""
    r = np.random.default_rng(1)
    x = r.integers(-9, 9, (70, 400)) * (r.random((70, 400)) < 0.02)
    q = r.integers(-9, 9, (9, 500)) * (r.random((9, 500)) < 0.05)
    terms, starts, rows, weights = topk_search.postings(x.ravel(), np.full(70, 400))
    got = topk_search.accumulate((terms, starts, rows, weights), 70, [(np.flatnonzero(y), y[y != 0]) for y in q])
    assert (got == x @ q[:, :400].T).all()


def test_search_few_and_none(spark):
    one = vectors(spark, [(50, [1.0, 2.0], 0)])
    assert topk_search.search(whole_vectors(one, "embedding", 256)).count() == 0
    two = vectors(spark, [(50, [1.0, 2.0], 0), (7, [3e38, 1.0], 0)])
    rows = topk_search.search(whole_vectors(two, "embedding", 256)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(50, 1, 7)]
    none = topk_search.search(whole_vectors(vectors(spark, []), "embedding", 256))
    assert none.collect() == [] and none.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def lloyd(kept, parts=8, entries=16, rounds=6):
    width = -(-max(len(x) for _, x, _ in kept) // parts)
    pad = [x + [0] * (parts * width - len(x)) for _, x, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[pad[k][p * width:(p + 1) * width] for k in order] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [[] for _ in book]
            for x in pad:
                y = x[p * width:(p + 1) * width]
                mine[near(y, book)[1]].append(y)
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(mine, book)]
    found = [[near(x[p * width:(p + 1) * width], book) for p, book in enumerate(books)] for x in pad]
    error = [sum(d for d, _ in f) for f in found]
    by = Counter()
    for (_, _, y), e in zip(kept, error):
        by[y] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), n, by[y], sha) for (i, _, y), f, n in zip(kept, found, error)]


@pytest.mark.parametrize("rows", [hostile(), hostile(width=9, n=30, seed=4), hostile()[:11], [(3, [1e30, -2.0], None)], [(3, [], 1), (4, [], 1)]])
def test_codes_equal_brute_force(spark, rows):
    rows = [(i, x, y) for i, x, y in rows]
    got = vector_codes.compress(whole_vectors(vectors(spark, rows).repartition(3), "embedding", 4096)).drop("label").collect()
    kept = whole(rows, 4096)
    hold = vector_codes.bound(8 * -(-max(len(x) for _, x, _ in kept) // 8))
    want = lloyd([(i, [max(-hold, min(hold, c)) for c in x], y) for i, x, y in kept])
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_codes_of_nothing(spark):
    out = vector_codes.compress(whole_vectors(vectors(spark, []), "embedding", 4096)).drop("label")
    assert out.collect() == [] and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_cover_tree_prunes_and_covers():
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(c, 40, (600, 3)) for c in (0, 4000, -4000, 9000)]).astype(np.int64)
    x = np.concatenate([x, np.repeat(x[:1], 500, axis=0)])
    tree = vector_codes.CoverTree.of(x)
    assert (np.sort(tree.perm) == np.arange(len(x))).all() and (x[tree.perm] == tree.points).all()
    for k in range(len(tree.low)):
        own = tree.points[tree.low[k]:tree.high[k]]
        assert ((own - tree.points[tree.centre[k]]) ** 2).sum(axis=1).max() <= tree.radius[k] ** 2
        inner = range(tree.child[k], tree.last[k])
        assert not inner or [(tree.low[j], tree.high[j]) for j in inner] == sorted((tree.low[j], tree.high[j]) for j in inner)
        assert not inner or (tree.low[inner[0]], tree.high[inner[-1]]) == (tree.low[k], tree.high[k])
    book = np.array([[0, 0, 0], [4000, 4000, 4000], [-4000, -4000, -4000], [9000, 9000, 9000]])
    code, sums, counts, single = tree.assign(book)
    assert (code == vector_codes.distances(tree.points, book).argmin(axis=1)).all()
    assert counts.sum() == len(x) and (sums.sum(axis=0) == x.sum(axis=0)).all()
    assert single == 0  # far clusters go as whole subtrees


DOCS = "doc_id long, text string, source string, lang string, mask string, part string, id string, n string, good string, label_id string"


def audited(docs, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    least: dict = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", math.inf), math.inf if i is None else i)
    out: dict = {}
    for i, t, s in docs:
        t = t or ""
        words = [w for w in t.translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": least[t] < (math.inf if i is None else i)}
        part = out.setdefault(s or "", {})
        for order in permutations("ABCDE"):
            alive = True
            for step, f in enumerate(order, 1):
                c = part.setdefault(("".join(order), step), Counter())
                c["kept"] += alive and not fails[f]
                if fails[f]:
                    c["removed"] += alive
                    c["redundant"] += not alive
                    c["unique_fails"] += sum(fails.values()) == 1
                    c["good_lost"] += alive and i in good
                    c["toxic_lost"] += alive and i in toxic
                    part.setdefault(f, Counter())["shapley"] += alive
                    alive = False
    return {(s, o, k): (*[c[n] for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")], part.get(o[k - 1], Counter())["shapley"])
            for s, part in out.items() for key, c in part.items() if len(key) == 2 for o, k in [key]}


def test_audit_equals_brute_force(spark):
    r = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    text = lambda n, pool: " ".join(r.choice(pool) for _ in range(n))
    docs = []
    for i in range(60):
        t = text(r.choice([20, 199, 200, 300]), words if r.random() < 0.6 else words[:60])
        t = t.upper() if r.random() < 0.2 else t
        t += r.choice(["", "", "\t\r\n\x0b\x0c ", " #", " | x"])
        docs.append((i, t, r.choice(["a", "b", None])))
    docs += [(100 + k, docs[k % 9][1], docs[k % 4][2]) for k in range(40)]  # copies across sources
    docs += [(200, None, "a"), (201, "", ""), (202, "   ", "c"), (203, " É#" * 30, "a"), (5, docs[5][1], "b"), (7, "other", "b"), (None, docs[3][1], "a"), (None, "alone", "a"), (None, "alone", "a")]
    docs += [(300, text(30000, words), "long")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in range(110)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    d = spark.createDataFrame([(i, t, s, *["x"] * 7) for i, t, s in docs], DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(x["part"], x["filter_order"], x["step"]): tuple(x)[3:] for x in filter_audit.audit(d, lab).collect()}
    want = audited(docs, labels)
    assert len(got) == 600 * 5 and got == want
    none = lab.limit(0)
    assert filter_audit.audit(d.limit(0), none).collect() == []
    assert filter_audit.audit(d, none).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_audit_is_one_higher_order_fold():
    """600 structs a cell: 120 orders of 5 steps."""
    assert len(list(permutations(filter_audit.FILTERS))) * len(filter_audit.FILTERS) == 600
    assert json.dumps(filter_audit.TEXT_FILTERS + filter_audit.COPY) == '"ABCDE"'
