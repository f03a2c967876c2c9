"""Daily-value text of stations, and column states that merge."""

import random

from pyspark.sql import functions as F

from shoalkit.operators.profile import profile
from shoalkit.operators.sketch import column_states, merge_states, read_states
from shoalkit.session import scratch_path
from shoalkit.sources import store
from shoalkit.sources.daily import read_daily, write_daily

TEXT = """# retrieved for a test
# agency_cd\tnot a header
agency_cd\tsite_no\tdatetime\t85_00060_00003\t85_00060_00003_cd\t86_00010_00001\t86_00010_00001_cd
5s\t15s\t20d\t14n\t10s\t14n\t10s
USGS\t09261000\t1998-05-01\t1200.5\tA\t11.0\tP
USGS\t09261000\t1998-05-02\tIce\tA:e\t\t
USGS\t09261000\t1998-05-03
#
agency_cd\tsite_no\tdatetime\t90_00010_00011\t90_00010_00011_cd
5s\t15s\t20d\t14n\t10s
USGS\t09315000\t1998-05-01\t-0.5\tA
USGS\t09315000\tnot a day\t1\tA
"""


def test_sections_have_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.rdb").write_text(TEXT.replace("\n", "\r\n"))
    (tmp_path / "b.rdb").write_text("# no data\n")
    (tmp_path / "c.rdb").write_text("agency_cd\tsite_no\tdatetime\t1_00060_00003\n5s\t15s\t20d\t14n")
    got = {(r.staid, str(r.date), r.code, r.stat): (r.val, r.qualcode, r.series, r.value) for r in read_daily(spark, str(tmp_path)).collect()}
    assert got == {
        ("09261000", "1998-05-01", "00060", "00003"): (1200.5, "A", "85", "1200.5"), ("09261000", "1998-05-01", "00010", "00001"): (11.0, "P", "86", "11.0"),
        ("09261000", "1998-05-02", "00060", "00003"): (None, "A:e", "85", "Ice"),
        ("09315000", "1998-05-01", "00010", "00011"): (-0.5, "A", "90", "-0.5"), ("09315000", "None", "00010", "00011"): (1.0, "A", "90", "1")}


def test_daily_round_trip(spark):
    r = random.Random(2)
    rows = [(s, f"{y}-01-{k:02d}", c, t, r.choice([None, r.gauss(100, 50), 1e-7, 3.0]), r.choice([None, "A", "P:e"]))
            for s in ("09", "10") for y in (1998, 1999) for k in range(1, 20) for c, t in (("00060", "00003"), ("00010", "00011")) if r.random() < 0.7]
    d = spark.createDataFrame(rows, "staid string, date string, code string, stat string, val double, qualcode string").withColumn("date", F.to_date("date"))
    got = read_daily(spark, write_daily(d, scratch_path(spark, "t-daily"))).drop("series", "value")
    want = {tuple(x) for x in d.collect()}
    have = {tuple(x) for x in got.collect()}
    assert have == {x for x in want if x[4] is not None or x[5] is not None}
    assert read_daily(spark, write_daily(d.limit(0), scratch_path(spark, "t-daily"))).count() == 0


def test_states_merge_to_the_profile_of_all_rows(spark):
    d = spark.range(20000).selectExpr("id AS k", "CASE WHEN id % 7 = 0 THEN NULL ELSE cast(id % 50 AS int) END AS g", "id / 3.0D AS x",
                                      "CASE WHEN id % 3 = 0 THEN 'often' ELSE concat('t', id % 900) END AS t", "CAST(NULL AS string) AS none", "DATE'2020-01-01' + cast(id % 40 AS int) AS day")
    parts = [column_states(d.where(f"k % 4 = {i}")) for i in range(4)] + [column_states(d.limit(0))]
    states = parts[0]
    for p in parts[1:]:
        states = states.unionByName(p)
    got = {r.column: r for r in read_states(merge_states(states)).collect()}
    want = {r.column: r for r in profile(d, quantiles=(0.25, 0.5, 0.75)).collect()}
    for c, w in want.items():
        g = got[c]
        assert (g.type, g.n, g.n_missing) == (w.type, w.n, w.n_missing)
        assert abs(g.n_distinct - w.n_distinct) <= max(1, 0.04 * w.n_distinct)
        assert (g.min, g.max) == (w.min, w.max)
    assert got["t"].mode == "often" and got["none"].mode is None
    assert all(abs(float(got["k"][f"q{q}"]) - 200 * q) < 200 for q in (25, 50, 75)) and got["t"].q50 is None


def test_store_profile_reads_states_only(spark):
    root = scratch_path(spark, "t-prof")
    site = spark.range(100).selectExpr("concat('s', id) AS site_id", "cast(id % 5 AS int) AS pass")
    store.append(spark, {"site": site.where("pass < 2")}, root, sketch=True)
    store.append(spark, {"site": site.where("pass >= 2")}, root, sketch=True)
    p = store.profile(spark, root, "site")
    assert all("/states/" in f for f in p.inputFiles())
    assert {(r.column, r.n, r.n_distinct, r.min, r.max) for r in p.collect()} == {("site_id", 100, 100, "s0", "s99"), ("pass", 100, 5, "0", "4")}
    store.append(spark, {"site": site.limit(1)}, root)  # without states: its rows are read
    assert {r.n for r in store.profile(spark, root, "site").collect()} == {101}
    assert store.profile(spark, root, "fish") is None
