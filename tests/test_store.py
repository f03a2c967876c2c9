"""The store's commit log, key index and snapshots."""

import threading

import pytest
from pyspark.sql import functions as F

from shoalkit.operators import integrity as ck
from shoalkit.plans import load
from shoalkit.session import scratch_path
from shoalkit.sources import store
from shoalkit.sources.sinks import append_batch, snapshot_store

SITE = "site_id string, project_code string, year int, upload_id int"
FISH = "fish_id string, site_id string"


def sites(spark, names, upload_id=1):
    return spark.createDataFrame([(n, "p", 2020, upload_id) for n in names], SITE)


def names(spark, root, table="site"):
    df = store.read(spark, root, table)
    return [] if df is None else sorted(r[0] for r in df.select(df.columns[0]).collect())


def test_a_load_that_dies_between_tables_leaves_nothing_readable(spark):
    root = scratch_path(spark, "t-log")
    append_batch({"site": sites(spark, "a")}, root)
    boom = F.udf(lambda x: 1 // 0, "string")
    bad = spark.createDataFrame([("f", "b")], FISH).withColumn("site_id", boom("site_id"))
    with pytest.raises(Exception, match="ZeroDivision"):
        append_batch({"site": sites(spark, "b"), "fish": bad}, root)
    assert names(spark, root) == ["a"] and store.read(spark, root, "fish") is None and store.latest(spark, root) == 1
    gone = store.vacuum(spark, root)
    assert len(gone) == 2 and all("batch=" in g for g in gone) and names(spark, root) == ["a"]
    append_batch({"site": sites(spark, "b")}, root)  # the retry meets no rows of its own
    assert names(spark, root) == ["a", "b"]


def test_put_if_absent_keeps_the_first(spark):
    path = scratch_path(spark, "t-put") + "/1.json"
    assert store.put_if_absent(spark, path, "one") and not store.put_if_absent(spark, path, "two")
    assert spark.read.text(path).first()[0] == "one"
    assert store.listing(spark, path.rsplit("/", 1)[0]) == ["1.json"]


def test_loads_at_once_all_land(spark):
    root = scratch_path(spark, "t-log")
    failed = []

    def run(k):
        try:
            append_batch({"site": sites(spark, [f"s{k}"])}, root)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and store.latest(spark, root) == 4
    assert names(spark, root) == ["s0", "s1", "s2", "s3"]


def meta_and_site(spark, name):
    meta = spark.createDataFrame([(None, "p", 2020, "Pat", "Doe", "UDWR-M", "EL")], ck.STORE_SCHEMAS["meta"])
    site = spark.createDataFrame([(name, "p", 2020, "GR", "LGR", 1.0, 0.5, "R", 1200)], "site_id string, project_code string, year int, "
                                 "river string, reach string, start_rmi double, end_rmi double, shoreline string, el_sec int")
    at = F.to_timestamp_ntz(F.lit("2020-07-01 08:00:00"))
    return meta, site.withColumn("startdatetime", at).withColumn("enddatetime", at)


def test_overtaken_load_is_validated_again(spark, monkeypatch):
    """Another load commits the same key while this one writes: it is refused, and with another key it gets a new upload id."""
    meta, site = meta_and_site(spark, "a")
    for own, written in (("a", []), ("b", ["site"])):
        root, first = scratch_path(spark, "t-log"), []
        load.load_batch(spark, {"meta": meta}, root, number_meta=True)
        stage = store.stage

        def late(*args):
            if not first:
                first.append(1)
                load.load_batch(spark, {"site": site}, root)
            return stage(*args)

        monkeypatch.setattr(store, "stage", late)
        violations, got, upload_id = load.load_batch(spark, {"site": site.withColumn("site_id", F.lit(own))}, root)
        monkeypatch.undo()
        assert got == written and upload_id == 2
        assert (violations.filter("rule = 'primary_key_store'").count() == 1) == (own == "a")
        assert names(spark, root) == (["a"] if own == "a" else ["a", "b"])
        assert store.vacuum(spark, root) == []  # what the overtaken try wrote is gone


def test_stream_beside_append(spark):
    from shoalkit.streaming.batch_stream import load_stream
    root, landing, ckpt = (scratch_path(spark, x) for x in ("t-log", "t-landing", "t-ckpt"))
    rules = {"site": {"pk": ["site_id"], "not_null": ["site_id"]}}
    append_batch({"site": sites(spark, "a")}, root)
    sites(spark, "b").write.parquet(landing + "/d1")
    load_stream(spark, landing + "/*", "site", SITE, root, ckpt, rules=rules)
    append_batch({"site": sites(spark, "c")}, root)
    sites(spark, "c").write.parquet(landing + "/d2")  # clashes with the plain append
    load_stream(spark, landing + "/*", "site", SITE, root, ckpt, rules=rules)
    assert names(spark, root) == ["a", "b", "c"]
    assert spark.read.parquet(root + "/violations/site").count() == 1


def test_replayed_source_is_not_loaded_twice(spark):
    root = scratch_path(spark, "t-log")
    assert store.append(spark, {"site": sites(spark, "a")}, root, source="q#0") == 1
    assert store.append(spark, {"site": sites(spark, "a")}, root, source="q#0") == 1
    assert store.append(spark, {"site": sites(spark, "b")}, root, source="q#1") == 2
    assert names(spark, root) == ["a", "b"]


def test_old_versions_and_new_columns(spark):
    root = scratch_path(spark, "t-log")
    append_batch({"site": sites(spark, "a")}, root)
    append_batch({"site": sites(spark, "b").withColumn("boat", F.lit("B1"))}, root)
    assert {(r.site_id, r.boat) for r in store.read(spark, root, "site").collect()} == {("a", None), ("b", "B1")}
    assert [r.site_id for r in store.read(spark, root, "site", 1).collect()] == ["a"]


def test_snapshots_share_files_and_survive_loads(spark):
    root, archive = scratch_path(spark, "t-log"), scratch_path(spark, "t-archive")
    append_batch({"site": sites(spark, "ab")}, root)
    one = snapshot_store(spark, root, archive, "20200101", 1)
    append_batch({"site": sites(spark, "c"), "fish": spark.createDataFrame([("f", "c")], FISH)}, root)
    two = snapshot_store(spark, root, archive, "20200102", 2)
    assert [n for n in store.listing(spark, archive)] == ["20200101_uid-1.json", "20200102_uid-2.json"]  # no data file
    assert sorted(r.site_id for r in store.read_snapshot(spark, one, "site").collect()) == ["a", "b"]
    assert sorted(r.site_id for r in store.read_snapshot(spark, two, "site").collect()) == ["a", "b", "c"]
    assert store.read_snapshot(spark, one, "fish") is None
    with pytest.raises(FileExistsError):
        snapshot_store(spark, root, archive, "20200102", 2)
    assert store.vacuum(spark, root, [one, two]) == []
    assert store.damaged(spark, two).count() == 0
    store._remove(spark, f"{root}/" + store.manifests(spark, root, 1)[0]["tables"][0]["path"])
    assert store.damaged(spark, one).count() == store.damaged(spark, two).count() > 0


def test_key_index_reads_few_files_and_loses_no_key(spark):
    root = scratch_path(spark, "t-log")
    for k in range(5):  # overlapping key ranges in every file
        append_batch({"fish": spark.range(2000).selectExpr(f"concat('f', id * 5 + {k}) AS fish_id", "'s' AS site_id").repartition(3)}, root)
    all_files = len(store.read(spark, root, "fish").inputFiles())
    asked = [f"f{i}" for i in (0, 7, 4996, 9999)] + ["g", "f", "f99990", ""]
    keys = spark.createDataFrame([(x,) for x in asked], "site string")
    got = store.with_keys(spark, root, "fish", keys)
    read = got.inputFiles()
    assert 4 <= len(read) < all_files
    held = got.join(keys.withColumnRenamed("site", "fish_id"), "fish_id", "left_semi")  # false positives go
    assert sorted(r.fish_id for r in held.collect()) == ["f0", "f4996", "f7", "f9999"]
    whole = store.with_keys(spark, root, "fish", store.read(spark, root, "fish").select("fish_id"))
    assert whole.count() == 10000  # no key is lost
    assert store.with_keys(spark, root, "fish", keys.where("site = 'g'")).count() == 0
    assert store.with_keys(spark, root, "fish", keys.limit(0)).count() == 0
    assert store.with_keys(spark, root, "vial", keys) is None


def test_rules_of_a_table_are_one_scan(spark):
    df = spark.createDataFrame([("a", "XX", 0), ("a", None, 5), (None, "XX", 0)], "site_id string, river string, el_sec int")
    v = ck.check_rules(df, "site", ["site_id", "year"], {"river": ck.RIVERS}, ["el_sec", "absent"])
    assert {(r.rule, r.column, r.key, r.n) for r in v.collect()} == {
        ("not_null", "site_id", None, 1), ("not_null", "year", None, 3), ("domain", "river", "XX", 2), ("nonzero", "el_sec", None, 2)}
    path = scratch_path(spark, "t-scan")
    df.write.parquet(path)
    plan = ck.check_rules(spark.read.parquet(path), "site", ["site_id"], {"river": ck.RIVERS}, ["el_sec"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert ck.check_rules(df, "site").count() == 0


def test_split_rows_rejects_children_of_rejected_parents(spark):
    rules = {"site": {"pk": ["site_id"], "not_null": ["site_id"], "domain": {"river": ["GR"]}, "nonzero": ["el_sec"]},
             "fish": {"pk": ["fish_id"], "not_null": ["fish_id"], "fk": [(["site_id"], "site", ["site_id"])]}}
    site = spark.createDataFrame([("a", "GR", 1), ("b", "XX", 1), ("c", "GR", 0), (None, "GR", 1), ("d", None, None), ("e", "GR", 2), ("e", "GR", 1), ("a", "GR", 1)],
                                 "site_id string, river string, el_sec int")
    fish = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "zz"), ("4", None), (None, "a"), ("5", "e")], FISH)
    good, bad = ck.split_rows(site, "site", rules=rules)
    assert sorted(map(str, map(tuple, good.collect()))) == ["('a', 'GR', 1)", "('d', None, None)", "('e', 'GR', 1)"]
    assert sorted(str(r.site_id) for r in bad.collect()) == ["None", "b", "c", "e"]
    kept, lost = ck.split_rows(fish, "fish", {"site": good}, rules)
    assert sorted(r.fish_id for r in kept.collect()) == ["1", "4", "5"] and lost.count() == 3
