"""Property tests: global index vs a pandas model, flags vs a three-valued model,
UTM vs an independent series, streaming and release idempotency."""

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoalkit.functions import nulls as N
from shoalkit.functions.geo import utm_xy
from shoalkit.operators import keys
from shoalkit.session import scratch_path

from .conftest import SF_MID

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 10_000)),
                min_size=1, max_size=200, unique_by=lambda r: r[1]),
       st.integers(1, 9))
def test_global_index_matches_sorted_rank(spark, rows, parts):
    df = spark.createDataFrame(rows, "t int, k int")
    got = keys.global_index(df, ["t", "k"], "i", partitions=parts).toPandas()
    model = pd.DataFrame(rows, columns=["t", "k"])
    model["_null"] = model["t"].isna()
    model = model.sort_values(["_null", "t", "k"]).reset_index(drop=True)
    model["i"] = range(1, len(model) + 1)
    merged = got.merge(model[["k", "i"]], on="k", suffixes=("", "_m"))
    assert len(merged) == len(rows)
    assert (merged["i"] == merged["i_m"]).all()


def _r_flag(x, lo):
    # ifelse(x > lo, "FLAG", "") in R: NA stays NA
    if x is None:
        return None
    return "FLAG" if x > lo else ""


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=50), st.integers(-10, 10))
def test_flag_matches_three_valued_model(spark, xs, lo):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x int")
    got = [r.f for r in df.orderBy("i").select(N.flag(F.col("x") > lo).alias("f")).collect()]
    assert got == [_r_flag(x, lo) for x in xs]


def _snyder_utm(lat, lon, lon0=-111.0):
    """Snyder (1987) ellipsoidal transverse Mercator, eqs. 8-9..8-10 (independent form)."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = math.radians(lat), math.radians(lon)
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t = math.tan(phi) ** 2
    c = ep2 * math.cos(phi) ** 2
    aa = (lam - math.radians(lon0)) * math.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi
             - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * math.sin(2 * phi)
             + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * math.sin(4 * phi)
             - (35 * e2 ** 3 / 3072) * math.sin(6 * phi))
    x = k0 * n * (aa + (1 - t + c) * aa ** 3 / 6 + (5 - 18 * t + t ** 2 + 72 * c - 58 * ep2) * aa ** 5 / 120)
    y = k0 * (m + n * math.tan(phi) * (aa ** 2 / 2 + (5 - t + 9 * c + 4 * c ** 2) * aa ** 4 / 24
                                         + (61 - 58 * t + t ** 2 + 600 * c - 330 * ep2) * aa ** 6 / 720))
    return 500000.0 + x, y


def test_utm_matches_independent_series(spark):
    pts = [(38.57, -109.55), (37.0, -111.0), (40.5, -113.2), (39.1, -108.7), (41.9, -112.4)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    x, y = utm_xy("lon", "lat")
    got = df.select("lat", "lon", x.alias("x"), y.alias("y")).collect()
    for r in got:
        sx, sy = _snyder_utm(r.lat, r.lon)
        assert abs(r.x - sx) < 0.01 and abs(r.y - sy) < 0.01


def test_stream_load_is_incremental_and_idempotent(spark):
    from shoalkit.sources import store
    from shoalkit.streaming.batch_stream import load_stream
    schema = "site_id string, project_code string, year int"
    landing = scratch_path(spark, "t-landing").replace("file:", "")
    root = scratch_path(spark, "t-store")
    ckpt = scratch_path(spark, "t-ckpt")
    rules = {"site": {"pk": ["site_id"], "not_null": ["site_id"]}}
    spark.createDataFrame([("a", "p", 2020), ("b", "p", 2020)], schema).write.parquet(landing + "/d1")
    load_stream(spark, landing + "/*", "site", schema, root, ckpt, rules=rules)
    load_stream(spark, landing + "/*", "site", schema, root, ckpt, rules=rules)  # nothing new
    assert store.read(spark, root, "site").count() == 2
    spark.createDataFrame([("c", "p", 2020)], schema).write.parquet(landing + "/d2")
    load_stream(spark, landing + "/*", "site", schema, root, ckpt, rules=rules)
    assert store.read(spark, root, "site").count() == 3
    # a delivery repeating a stored key is refused and reported
    spark.createDataFrame([("a", "p", 2020)], schema).write.parquet(landing + "/d3")
    load_stream(spark, landing + "/*", "site", schema, root, ckpt, rules=rules)
    assert store.read(spark, root, "site").count() == 3
    assert spark.read.parquet(root + "/violations/site").filter("rule = 'primary_key_store'").count() == 1


def test_release_replaces_only_its_project_year(spark):
    from pathlib import Path
    from shoalkit.sources.files import read_release
    from shoalkit.sources.sinks import write_release
    path = scratch_path(spark, "t-release")
    a = spark.createDataFrame([("s1", "p", 2020), ("s2", "q", 2021)], "site_id string, project_code string, year int")
    write_release({"site": a}, path, "p", 2020)
    write_release({"site": a}, path, "q", 2021)
    b = spark.createDataFrame([("s9", "p", 2020)], "site_id string, project_code string, year int")
    write_release({"site": b}, path, "p", 2020)
    got = sorted(tuple(r) for p, y in (("p", 2020), ("q", 2021)) for r in read_release(spark, path, p, y, "site").collect())
    assert got == [("s2", "q", 2021), ("s9", "p", 2020)]
    # a release with a changed, lost or added file is refused
    file = Path(read_release(spark, path, "p", 2020, "site").inputFiles()[0].replace("file://", ""))
    file.write_bytes(file.read_bytes()[:-1])
    (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(ValueError, match="not what was released"):
        read_release(spark, path, "p", 2020, "site")
    assert read_release(spark, path, "q", 2021, "site").count() == 1
    with pytest.raises(FileNotFoundError):
        read_release(spark, path, "p", 1999, "site")


def test_hot_site_results_stay_whole(spark):
    """One site holds a third of all fish: CPUE grid, natural full join and key checks."""
    from shoalkit.operators import integrity as ck
    from shoalkit.operators.joins import natural_join
    from shoalkit.plans.effort import cpue
    n = 3000
    sites = spark.createDataFrame(
        [(f"s{i}", 1998, 3600, "GR", "LGR", None) for i in range(60)],
        "site_id string, year int, el_sec int, river string, reach string, startdatetime timestamp_ntz")
    fish = spark.createDataFrame(
        [(f"f{i}", "s0" if i % 3 == 0 else f"s{1 + i % 50}", ["CS", "SM", None][i % 3])
         for i in range(n)], "fish_id string, site_id string, species string")
    c = cpue(sites, fish, [1998])
    assert c.count() == 60 * 2  # 60 sites x {SM, CS}
    assert c.agg(F.sum("fish_ct")).first()[0] == fish.filter(F.col("species").isNotNull()).count()
    hot = {r.spp_code: r.fish_ct for r in c.filter("site_id = 's0'").collect()}
    assert hot == {"CS": n // 3, "SM": 0}
    j = natural_join(sites.select("site_id", "reach"), fish, "full", null_safe=True)
    assert j.count() == n + 9  # every fish, plus the 9 sites without fish
    assert j.filter(F.col("fish_id").isNull()).count() == 9
    fk = ck.check_foreign_key(fish, sites.filter("site_id <> 's0'"), ["site_id"], table="fish").collect()
    assert [(r.key, r.n) for r in fk] == [("s0", n // 3)]


def test_empty_inputs(spark):
    from shoalkit.operators import integrity as ck
    from shoalkit.operators.distribution import histogram
    from shoalkit.operators.profile import profile
    from shoalkit.plans.effort import cpue
    sites = spark.createDataFrame([("s1", 1998, 3600, "GR", "LGR", None)],
                                  "site_id string, year int, el_sec int, river string, reach string, "
                                  "startdatetime timestamp_ntz")
    nofish = spark.createDataFrame([], "fish_id string, site_id string, species string")
    assert cpue(sites, nofish, [1998]).count() == 0  # no species seen: the grid is empty, as in R
    empty = spark.createDataFrame([], "t int, k int")
    assert keys.global_index(empty, ["t", "k"], "i").count() == 0
    assert ck.validate_table(spark, "site", sites.limit(0).withColumn("upload_id", F.lit(1))).count() == 0
    assert histogram(empty, "t", bins=10).count() == 0
    assert histogram(empty, "t", width=5).count() == 0
    prof = {r.column: r for r in profile(empty).collect()}
    assert prof["t"].n == 0 and prof["t"].n_distinct == 0 and prof["t"].mode is None


def test_bucketed_store_joins_without_exchange(spark):
    from shoalkit.fixtures import tables
    from shoalkit.sources.sinks import write_bucketed
    t = tables(spark, SF_MID)
    import uuid
    db = f"shoal_test_{uuid.uuid4().hex[:8]}"  # the in-memory catalog forgets tables, not folders
    spark.sql(f"CREATE DATABASE {db}")
    write_bucketed({"site": t.site, "fish": t.fish}, db, 8, mode="overwrite")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(f"{db}.fish").join(spark.table(f"{db}.site"), "site_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == t.fish.join(t.site.select("site_id"), "site_id", "left_semi").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["X", "Y", None]),
                          st.integers(1, 9)), min_size=1, max_size=25,
                unique_by=lambda r: (r[0], r[1])))
def test_complete_matches_model(spark, rows):
    from shoalkit.operators.aggregate import complete
    df = spark.createDataFrame(rows, "l string, r string, n long")
    key = lambda t: tuple((v is None, "" if v is None else v) for v in t)
    got = sorted(((x.l, x.r, x.n) for x in complete(df, ["l"], ["r"], fill={"n": 0}).collect()), key=key)
    have = {(r[0], r[1]): r[2] for r in rows}
    want = [(a, b, have.get((a, b), 0)) for a in {r[0] for r in rows} for b in {r[1] for r in rows}]
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(500, 9000))), min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(0, 15), st.sampled_from(["SM", "CS", None])), max_size=40))
def test_effort_stats_matches_model(spark, sites, fish_rows):
    import decimal
    from shoalkit.plans.effort import effort_stats
    site = spark.createDataFrame([(f"s{i}", p, e) for i, (p, e) in enumerate(sites)],
                                 "site_id string, pass int, el_sec int")
    fish = spark.createDataFrame([(f"s{i}", sp) for i, sp in fish_rows], "site_id string, species string")
    got = {r["pass"]: (r.n_site, r.effort_hr, r.catch, r.cpue) for r in effort_stats(site, fish, ["SM"]).collect()}

    def rround(x):  # half-even on x * 100, as R and round_even do
        if x is None:
            return None
        return float(decimal.Decimal(repr(x * 100)).quantize(decimal.Decimal(1), decimal.ROUND_HALF_EVEN)) / 100

    want = {}
    for p in {p for p, _ in sites}:
        idx = [i for i, (q, _) in enumerate(sites) if q == p]
        secs = [sites[i][1] for i in idx]
        eff = None if any(s is None for s in secs) else rround(sum(secs) / 3600)
        catch = sum(1 for i, sp in fish_rows if sp == "SM" and i in idx)
        cpue = None if eff in (None, 0) else rround(catch / eff)
        want[p] = (len(idx), eff, catch, cpue)
    assert got == want
