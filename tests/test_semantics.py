"""Three-valued rules (N1-N12), rounding, keys, geometry and properties."""


from pyspark.sql import functions as F

from shoalkit.functions import nulls as N
from shoalkit.functions.geo import utm_xy
from shoalkit.operators import aggregate as agg
from shoalkit.operators import keys
from shoalkit.operators import quality as qc

from .conftest import SF_MID


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,), (10,)], "x int")
    out = df.select(N.flag(F.col("x") > 5).alias("f")).collect()
    assert [r.f for r in out] == ["", None, "FLAG"]


def test_in_set_never_null(spark):
    df = spark.createDataFrame([("CS",), (None,), ("QQ",)], "s string")
    out = df.select(N.in_set("s", ["CS"]).alias("a"), N.not_in_set("s", ["CS"]).alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [(True, False), (False, True), (False, True)]
    # a NULL inside the list matches a NULL value (R's match)
    assert spark.createDataFrame([(None,)], "s string").select(N.in_set("s", ["A", None])).first()[0] is True


def test_case_flag_without_default(spark):
    df = spark.createDataFrame([("134", "1" * 14), ("134", "12"), ("400", "1" * 9), ("999", "1")],
                               "t string, n string")
    rules = dict(qc.pit_rules())
    got = [r[0] for r in df.withColumn("f_index", F.lit(1)).withColumn("pit_recap", F.lit("Y"))
           .withColumnRenamed("t", "pit_type").withColumnRenamed("n", "pit_num")
           .select(rules["invalid_pitnum_flg"]).collect()]
    assert got == [None, "FLAG", None, None]


def test_strict_and_lenient_sum(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("c", None)], "g string, x int")
    out = {r.g: (r.s, r.l) for r in df.groupBy("g").agg(N.strict_sum("x").alias("s"),
                                                          N.lenient_sum("x").alias("l")).collect()}
    assert out == {"a": (None, 1), "b": (2, 2), "c": (None, 0)}


def test_r_round_matches_r(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (174.255,), (2.5,), (1.125,)], "x double")
    got = [r[0] for r in df.select(N.r_round("x", 2)).collect()]
    assert got[0] == 1.0      # stored as 1.00499..., not a tie
    assert got[1] == 0.12     # exact tie goes to even
    assert got[4] == 1.12
    assert df.select(N.r_round("x", 0)).collect()[3][0] == 2.0


def test_pad_never_truncates_and_paste_na(spark):
    df = spark.createDataFrame([(5, "p"), (1234, None)], "n int, p string")
    got = [r[0] for r in df.select(keys.build_key([F.col("p"), F.lit(2020)], F.col("n"))).collect()]
    assert got == ["p_2020_005", "NA_2020_1234"]


def test_sub_first(spark):
    df = spark.createDataFrame([("Utah Division abc",)], "s string")
    assert df.select(N.sub_first(F.col("s"), "[a-z]+")).first()[0] == "U Division abc"


def test_utm_known_answer(spark):
    x, y = utm_xy(F.lit(-109.55), F.lit(38.57))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x - 626317.488) < 0.01
    assert abs(r.y - 4270057.441) < 0.01


def _idx(spark, parts):
    from shoalkit.fixtures import tables
    s = tables(spark, SF_MID).site.select("key_a", "startdatetime")
    return keys.global_index(s, ["startdatetime", "key_a"], "i", partitions=parts)


def test_global_index_gap_free_and_partition_independent(spark):
    a = {r.key_a: r.i for r in _idx(spark, 3).collect()}
    b = {r.key_a: r.i for r in _idx(spark, 17).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, len(a) + 1))


def test_global_index_hot_timestamp_is_split(spark):
    # a third of the rows share one timestamp: the tie-break still orders and splits them
    rows = [(i, "2020-01-01 00:00:00" if i % 3 == 0 else f"2020-01-{1 + i % 28:02d} 01:00:00") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t string").select("k", F.to_timestamp_ntz("t").alias("t"))
    per_part = keys._sealed(df.select("t", "k"), 8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r[1] for r in per_part) < 3000 / 3
    got = keys.global_index(df, ["t", "k"], "i", partitions=8)
    pdf = got.toPandas().sort_values("i")
    assert list(pdf["i"]) == list(range(1, 3001))
    assert list(pdf.sort_values(["t", "k"])["k"]) == list(pdf["k"])


def test_global_index_seals_order_columns_only(spark):
    """Rows themselves are neither sorted nor written, and a narrow read stays narrow."""
    from shoalkit.session import scratch_path
    path = scratch_path(spark, "t-wide")
    spark.range(1000).selectExpr("id AS k", "id % 7 AS t", "repeat('x', 200) AS wide").write.parquet(path)
    got = keys.global_index(spark.read.parquet(path), ["t", "k"], "i")
    plan = got.select("k", "i")._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD[t#" in plan and "ReadSchema: struct<k:bigint,t:bigint>" in plan
    assert [r.k for r in got.orderBy("i").limit(3).collect()] == [0, 7, 14]


def test_global_index_with_repeated_order_values(spark):
    df = spark.createDataFrame([(k % 3, None if k % 4 else "a", k) for k in range(50)] + [(1, "a", 1)] * 2, "t int, s string, v int")
    got = keys.global_index(df, ["t", "s"], "i", start=5).collect()
    assert sorted(r.i for r in got) == list(range(5, 57))
    order = [(r.t, r.s is None, r.s or "") for r in sorted(got, key=lambda r: r.i)]
    assert order == sorted(order)


def test_complete_grid_and_total(spark):
    df = spark.createDataFrame([("s1", "A", 2), ("s1", "B", 1), ("s2", "A", 4), ("s3", None, 1)],
                               "site string, sp string, n long")
    out = agg.complete(df, ["site"], ["sp"], fill={"n": 0})
    assert out.count() == 3 * 3
    assert out.agg(F.sum("n")).first()[0] == 8


def test_expand_grid_chunked_path(spark):
    left = spark.createDataFrame([(i,) for i in range(5)], "a int")
    right = spark.createDataFrame([(j,) for j in range(40)], "b int")
    for chunk in (10_000, 7):  # one chunk, and several
        out = agg.expand_grid(left, right, ["b"], bound=10, chunk=chunk)
        assert out.count() == 200
        assert out.distinct().count() == 200


def test_rare_and_untagged_split_the_fish(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    from shoalkit.fixtures import tables
    t = tables(spark, SF_MID)
    rare = q["vw_rare"](spark, SF_MID).count()
    ntf = q["vw_ntf"](spark, SF_MID).count()
    tagged_num = t.pittag.filter(F.col("pit_num").isNotNull()).select("fish_id")
    neither = t.fish.filter(F.col("species").isNull()).join(tagged_num, "fish_id", "left_anti").count()
    assert (rare, ntf) == (33573, 22577)
    assert rare + ntf + neither == t.fish.count()


def test_cpue_known_answer(spark):
    import __spark_entry__ as entry
    df = entry.queries()["dp_cpue"](spark, SF_MID)
    assert df.count() == 19980
    assert df.select("site_id").distinct().count() == 2220
    from shoalkit.fixtures import tables
    t = tables(spark, SF_MID)
    no_fish = (t.site.filter(F.col("year") == 1998).select("site_id")
               .join(t.fish.select("site_id"), "site_id", "left_anti"))
    assert no_fish.count() == 26
    zero = df.groupBy("site_id").agg(F.sum("fish_ct").alias("c")).filter("c = 0").select("site_id")
    # every fish-less site is kept with all-zero rows
    assert no_fish.join(zero, "site_id", "left_anti").count() == 0


def test_dbf_round_trip_and_families(spark, tmp_path):
    from shoalkit.fixtures import tables
    from shoalkit.sources.dbf import read_dbf, write_dbf
    t = tables(spark, SF_MID)
    src = t.raw_fish.limit(5000)
    write_dbf(src.repartition(3), str(tmp_path), "fish", prefix="a")
    write_dbf(t.raw_water.limit(100), str(tmp_path), "water", prefix="a")
    got = read_dbf(spark, str(tmp_path), family="fish", records_per_partition=700)
    assert got.rdd.getNumPartitions() >= 8
    back = got.select(*[F.col(f.name).cast(f.dataType) for f in src.schema.fields])
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
    both = read_dbf(spark, str(tmp_path))
    assert both.count() == 5100
    assert "h2o_notes" in both.columns and "species" in both.columns
    named = spark.read.format("dbf").option("path", str(tmp_path)).option("includeTable", "true").load()
    assert {r._table: r.n for r in named.groupBy("_table").agg(F.count("*").alias("n")).collect()} == \
        {"fish": 5000, "water": 100}


def test_views_by_name_and_timezone_free_stamp(spark):
    from shoalkit.fixtures import tables
    from shoalkit.plans.effort import as_of_col
    from shoalkit.plans.views import register_views
    t = tables(spark, SF_MID)
    register_views(t.site, t.meta, t.water_qual, t.fish, t.pittag, t.floytag)
    assert spark.sql("SELECT count(*) FROM vw_rare").first()[0] == 33573
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        v = spark.range(1).select(as_of_col().cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == "2020-12-31 00:00:00"


def test_wall_clock_seconds_ignore_time_zone(spark):
    from shoalkit.operators.clean import seconds_between
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        df = spark.createDataFrame([("2000-04-02 01:30:00", "2000-04-02 02:30:00"),
                                    ("2000-10-29 00:59:30", "2000-10-29 03:00:00")], "a string, b string")
        got = [r[0] for r in df.select(seconds_between(F.to_timestamp_ntz("a"), F.to_timestamp_ntz("b"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [3600.0, 7230.0]


def test_histogram_keeps_null_facet(spark):
    from shoalkit.operators.distribution import histogram
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 4.0), ("b", None)], "g string, x double")
    got = {(r.g, r.bin): r.n for r in histogram(df, "x", bins=2, by=["g"], per_group_range=True).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, (None, 0): 1, (None, 1): 1}


def test_profile_quantiles_within_rank_tolerance(spark):
    import numpy as np
    from shoalkit.fixtures import tables
    from shoalkit.operators.profile import profile
    site = tables(spark, SF_MID).site.select("el_sec", "start_rmi", "crew")
    prof = {r.column: r for r in profile(site, quantiles=(0.25, 0.5, 0.75)).collect()}
    vals = np.sort(np.array([r[0] for r in site.select("el_sec").collect() if r[0] is not None]))
    n = len(vals)
    for q, col in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        got = float(getattr(prof["el_sec"], col))
        rank = np.searchsorted(vals, got, side="right") / n
        assert abs(rank - q) < 0.01, (q, got, rank)
    assert prof["crew"].q50 is None


def test_mdy_like_lubridate(spark):
    from shoalkit.operators.clean import mdy, mdy_time
    df = spark.createDataFrame([("7/1/2020", "08:05:00"), ("07-01-20", "8:05"), ("12.31.69", "23:59:59"),
                                ("2/30/2020", "08:00:00"), ("Z", "08:00:00"), ("7/1/2020", "25:00:00")],
                               "d string, t string")
    got = [(r[0] and r[0].isoformat(), r[1] and r[1].isoformat(sep=" "))
           for r in df.select(mdy(F.col("d")), mdy_time(F.col("d"), F.col("t"))).collect()]
    assert got == [("2020-07-01", "2020-07-01 08:05:00"), ("2020-07-01", "2020-07-01 08:05:00"),
                   ("1969-12-31", "1969-12-31 23:59:59"), (None, None), (None, None), ("2020-07-01", None)]


def test_water_product_statistic_per_station(spark):
    from shoalkit.plans.products import water_product
    stations = spark.createDataFrame([("A", "Station A", "GR", "00003"), ("B", "Station B", "GR", "00011")],
                                     "staid string, sta_name string, rvr_code string, temp_stat string")
    rows = [("A", "2020-06-01", "00060", "00003", 100.0), ("A", "2020-06-01", "00010", "00003", 15.0),
            ("A", "2020-06-01", "00010", "00011", 99.0), ("B", "2020-06-01", "00010", "00011", 18.0),
            ("B", "2020-06-01", "00010", "00003", 77.0), ("B", "2020-06-02", "00060", "00003", 50.0),
            ("C", "2020-06-01", "00060", "00003", 1.0)]
    daily = spark.createDataFrame(rows, "staid string, d string, code string, stat string, val double") \
        .withColumn("date", F.to_date("d")).drop("d")
    got = {(r.staid, str(r.date)): (r.discharge, r.temp, r.sta_name)
           for r in water_product(daily, stations, 2020).collect()}
    assert got == {("A", "2020-06-01"): (100.0, 15.0, "Station A"),
                   ("B", "2020-06-01"): (None, 18.0, "Station B"),
                   ("B", "2020-06-02"): (50.0, None, "Station B")}


def test_dbf_types_round_trip(spark, tmp_path):
    import datetime as dt
    from shoalkit.sources.dbf import read_dbf, write_dbf
    rows = [(1, 2.5, "a b", dt.date(2020, 7, 1), True), (None, None, None, None, None),
            (-7, -0.125, "x", dt.date(1999, 12, 31), False)]
    df = spark.createDataFrame(rows, "n int, x double, s string, d date, b boolean")
    write_dbf(df.coalesce(1), str(tmp_path), "t", prefix="z")
    got = sorted(read_dbf(spark, str(tmp_path)).collect(), key=lambda r: (r.n is None, r.n or 0))
    assert [tuple(r) for r in got] == [(-7, -0.125, "x", dt.date(1999, 12, 31), False),
                                       (1, 2.5, "a b", dt.date(2020, 7, 1), True),
                                       (None, None, None, None, None)]


def test_date_time_clock_forms(spark):
    import datetime as dt
    from shoalkit.operators.clean import date_time
    df = spark.createDataFrame([("8:05:30.5",), (" 23:59 ",), ("8:60",), ("8",), ("1:2:3:4",), ("x:05",), (None,)],
                               "t string").withColumn("d", F.lit("2021-03-14").cast("date"))
    got = [r[0] for r in df.select(date_time(F.col("d"), F.col("t"))).collect()]
    assert got == [dt.datetime(2021, 3, 14, 8, 5, 30, 500000), dt.datetime(2021, 3, 14, 23, 59),
                   None, None, None, None, None]
