"""Validator finds planted errors and passes clean data; load is all-or-nothing."""

from pyspark.sql import functions as F

from shoalkit.operators import integrity as ck
from shoalkit.plans import load
from shoalkit.session import scratch_path
from shoalkit.sources import store


def _meta(spark):
    return spark.createDataFrame([(1, "abc", 2020, "Pat", "Doe", "UDWR-M", "EL")],
                                 "meta_id int, project_code string, year int, principal_fname string, "
                                 "principal_lname string, agency string, data_type string")


def _site(spark, rows):
    return spark.createDataFrame(rows, "site_id string, project_code string, year int, river string, reach string, "
                                       "start_rmi double, end_rmi double, shoreline string, el_sec int, upload_id int")


def _timed(site):
    return (site.withColumn("startdatetime", F.to_timestamp_ntz(F.lit("2020-07-01 08:00:00")))
            .withColumn("enddatetime", F.to_timestamp_ntz(F.lit("2020-07-01 09:00:00"))))


def test_absent_parent_and_absent_columns_are_violations(spark):
    fish = spark.createDataFrame([("f1", "nosite", 1.0, "SM", "RT"), ("f2", "nosite", 1.0, "SM", "RT")],
                                 "fish_id string, site_id string, rmi double, species string, disp string")
    v = ck.validate_table(spark, "fish", fish).collect()
    assert [(r.rule, r.key, r.n) for r in v] == [("foreign_key", "nosite", 2)]
    tag = spark.createDataFrame([("p1", "f1")], "pit_id string, fish_id string")
    v = ck.validate_table(spark, "pittag", tag, parents={"fish": fish}).collect()
    assert {(r.rule, r.column) for r in v} == {("not_null", c) for c in ("pit_recap", "pit_num", "pit_type")}
    _, written, _ = load.load_batch(spark, {"fish": fish}, scratch_path(spark, "test-store"))
    assert written == []


def test_validator_finds_planted_errors(spark):
    meta = _meta(spark)
    site = _site(spark, [("a", "abc", 2020, "GR", "LGR", 1.0, 0.5, "R", 1200, 1),
                         ("a", "abc", 2020, "XX", "LGR", 1.0, 0.5, "R", 0, 1),
                         ("b", "zzz", 2019, "GR", None, 1.0, 0.5, "R", 1200, 1)])
    v = ck.validate_table(spark, "site", site, parents={"meta": meta})
    got = {(r.rule, r.column) for r in v.collect()}
    assert ("primary_key", "site_id") in got
    assert ("domain", "river") in got
    assert ("nonzero", "el_sec") in got
    assert ("not_null", "reach") in got
    assert ("foreign_key", "project_code,year") in got


def test_validator_passes_clean_data(spark):
    meta = _meta(spark)
    site = _timed(_site(spark, [("a", "abc", 2020, "GR", "LGR", 1.0, 0.5, "R", 1200, 1)]))
    v = ck.validate_table(spark, "site", site, parents={"meta": meta})
    assert v.filter(F.col("severity") == "error").count() == 0


def test_null_lists_only_warn(spark):
    df = spark.createDataFrame([("X",), ("F",), (None,)], "sex string")
    r = ck.check_domain(df, "fish", "sex", ck.SEXES).collect()
    assert [(x.key, x.severity) for x in r] == [("X", "warn")]


def test_load_is_all_or_nothing(spark):
    root = scratch_path(spark, "test-store")
    meta = _meta(spark)
    good = _site(spark, [("a", "abc", 2020, "GR", "LGR", 1.0, 0.5, "R", 1200, 1)]).drop("upload_id")
    good = _timed(good)
    v, written, _ = load.load_batch(spark, {"meta": meta, "site": good}, root)
    assert written == ["meta", "site"]
    assert store.read(spark, root, "site").first().upload_id == 1
    # the same keys again clash with the store: nothing is written
    v2, written2, _ = load.load_batch(spark, {"meta": meta, "site": good}, root)
    assert written2 == []
    assert v2.filter(F.col("rule") == "primary_key_store").count() >= 1
    assert store.read(spark, root, "site").count() == 1
