"""Range joins over overlapping bounds against a plain nested loop."""

import random

import pytest
from pyspark.sql import functions as F

from shoalkit.operators import joins as jn


def nested(rows, bounds):
    out = []
    for i, k, v in rows:
        hit = [n for bk, lo, hi, n in bounds if k is not None and v is not None and lo is not None and bk == k and v >= lo and (hi is None or v < hi)]
        out += [(i, k, v, n) for n in hit or [None]]
    return sorted(out, key=str)


def joined(spark, rows, bounds, kind="double"):
    d = spark.createDataFrame(rows, f"i int, k string, v {kind}")
    b = spark.createDataFrame(bounds, f"_k string, _from {kind}, _to {kind}, name string")
    return jn.interval_join(d, "k", "v", b, ["name"])


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_bounds_equal_a_nested_loop(spark, seed):
    r = random.Random(seed)
    at = lambda: float(r.choice([r.randint(-20, 20), r.gauss(0, 10), 1e6, -1e6]))
    bounds = [(r.choice("abc"), at(), r.choice([at(), at(), None]), f"n{j}") for j in range(60)]
    bounds += bounds[:3] + [("a", 5.0, 5.0, "empty"), ("a", 7.0, 2.0, "turned"), (None, 0.0, 1.0, "nokey"), ("b", None, 3.0, "nolow"), ("d", 1.0, None, "open")]
    edges = [x for _, lo, hi, _ in bounds for x in (lo, hi) if x is not None]
    rows = [(i, r.choice(["a", "a", "b", "c", "d", "e", None]), r.choice([at(), r.choice(edges), None])) for i in range(400)]
    got = sorted((tuple(x) for x in joined(spark, rows, bounds).collect()), key=str)
    assert got == nested(rows, bounds)


def test_whole_numbers_and_no_bounds(spark):
    rows = [(1, "a", 10), (2, "a", 99), (3, "b", 5), (4, None, 5)]
    bounds = [("a", 0, 100, "x"), ("a", 10, 20, "y"), ("a", 10, 11, "z")]
    got = sorted((tuple(x) for x in joined(spark, rows, bounds, "int").collect()), key=str)
    assert got == nested(rows, bounds)
    assert sorted(x.i for x in joined(spark, rows, [], "int").collect()) == [1, 2, 3, 4]
    assert joined(spark, [], bounds, "int").count() == 0


def test_many_bounds_on_a_hot_key(spark):
    """100,000 overlapping bounds and a river with nearly all rows: equi-joins, and no task has the river to itself."""
    n = 100_000
    b = spark.range(n).selectExpr("if(id < 0, 'cold', 'hot') AS _k", "id * 1.0D AS _from", "id + 3.5D AS _to", "id AS name")
    d = spark.range(200_000).selectExpr("id AS i", "if(id % 50 = 0, 'cold', 'hot') AS k", f"(id * 7919 % {2 * n}) / 2.0D AS v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = jn.interval_join(d, "k", "v", b, ["name"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        sums = got.agg(F.count("name"), F.sum("name"), F.count_if(F.col("name").isNull())).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = [0, 0, 0]
    for i in range(200_000):
        v = (i * 7919 % (2 * n)) / 2
        hits = [] if i % 50 == 0 else [j for j in range(max(0, int(v) - 4), int(v) + 1) if j <= v < j + 3.5 and j < n]
        want = [want[0] + len(hits), want[1] + sum(hits), want[2] + (not hits)]
    assert list(sums) == want
    cells = d.join(jn._elementary(b).select("_k", "_lo", "_w", "_n").distinct(), F.col("k") == F.col("_k")).groupBy(jn._cell(F.col("v"))).count()
    assert cells.agg(F.max("count")).first()[0] < 20


def test_nodes_make_up_every_range(spark):
    pairs = [(a, b) for a in range(17) for b in range(a + 1, 18)]
    d = spark.createDataFrame(pairs, "a int, b int").select("a", "b", jn._nodes(F.col("a"), F.col("b"), 5).alias("x"))
    for r in d.collect():
        ranks = [k for n in r.x for k in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(ranks) == list(range(r.a, r.b)) and len(r.x) <= 10
