"""End to end: capture files -> extract -> proofing edits -> load -> refused reload."""

from pyspark.sql import functions as F

from shoalkit.fixtures import tables
from shoalkit.plans import jobs
from shoalkit.sources import store as log
from shoalkit.sources.dbf import write_dbf
from shoalkit.sources.files import read_bundle_sheet
from shoalkit.sources.sinks import write_bundle
from shoalkit.session import scratch_path

from .conftest import SF_SMALL

PEOPLE = {"principal_fname": "Pat", "principal_lname": "Doe", "agency": "UDWR-M", "data_type": "EL"}


def _captures(spark, folder):
    t = tables(spark, SF_SMALL)
    site = t.raw_site.filter(F.col("project") == "BUILDING")
    keys = site.select("key_a")
    write_dbf(site, folder, "site", prefix="123a")
    for name, df in [("water", t.raw_water), ("fish", t.raw_fish), ("pittag", t.raw_pittag),
                     ("floytag", t.raw_floytag), ("vial", t.raw_vial)]:
        write_dbf(df.join(keys, "key_a", "left_semi"), folder, name, prefix="123a")
    return site.count()


def _proof(spark, bundle):
    """What the human proofing step does: resolve every flagged value."""
    s = read_bundle_sheet(spark, bundle, "ck_site")
    s = s.withColumns({
        "reach": F.coalesce("reach", F.lit("OT")), "river": F.coalesce("river", F.lit("OT")),
        "shoreline": F.coalesce("shoreline", F.lit("UNK")),
        "enddatetime": F.coalesce("enddatetime", "startdatetime"),
        "el_sec": F.when(F.col("el_sec") == 0, F.lit(1)).otherwise(F.col("el_sec")),
    })
    f = read_bundle_sheet(spark, bundle, "ck_fish").filter(F.col("fish_id").isNotNull())
    f = f.withColumns({
        "species": F.when(F.col("species").isNull() | (F.col("species") == "QQ"), F.lit("UI")).otherwise(F.col("species")),
        "disp": F.coalesce("disp", F.lit("UNK")),
    })
    p = read_bundle_sheet(spark, bundle, "ck_pit")
    p = p.filter(F.col("pit_num").isNotNull()).withColumn("pit_recap", F.coalesce("pit_recap", F.lit("UNK")))
    fl = read_bundle_sheet(spark, bundle, "ck_floy").withColumn("floy_recap", F.coalesce("floy_recap", F.lit("UNK")))
    return {"meta": read_bundle_sheet(spark, bundle, "meta"), "ck_site": s, "ck_fish": f, "ck_pit": p,
            "ck_floy": fl, "water": read_bundle_sheet(spark, bundle, "water")}


def test_extract_proof_load_reload(spark, tmp_path):
    n_sites = _captures(spark, str(tmp_path / "dbf"))
    store = scratch_path(spark, "wf-store")
    t = tables(spark, SF_SMALL)
    paths = jobs.extract(spark, str(tmp_path / "dbf"), store, scratch_path(spark, "wf-bundles"), "2020_x",
                         PEOPLE, t.tbl_reach)
    raw_bundle = paths["ck_site"].rsplit("/", 1)[0]
    assert read_bundle_sheet(spark, raw_bundle, "ck_site").count() == n_sites
    # unproofed data is refused
    v, written, _ = jobs.load(spark, raw_bundle, store)
    assert written == [] and v.filter("severity = 'error'").count() > 0
    # proofed data loads completely, in foreign-key order, with ids assigned
    final = write_bundle(_proof(spark, raw_bundle), scratch_path(spark, "wf-final"))
    final_bundle = final["ck_site"].rsplit("/", 1)[0]
    v, written, snap = jobs.load(spark, final_bundle, store, archive_root=scratch_path(spark, "wf-archive"),
                                 date="20201231")
    assert v.filter("severity = 'error'").count() == 0, v.filter("severity = 'error'").collect()
    assert written == ["meta", "site", "water_qual", "fish", "pittag", "floytag"]
    site = log.read(spark, store, "site")
    assert site.count() == n_sites and site.select("upload_id").distinct().collect()[0][0] == 1
    assert log.read(spark, store, "meta").filter(F.col("meta_id").isNull()).count() == 0
    assert log.read_snapshot(spark, snap, "fish").count() == log.read(spark, store, "fish").count()
    assert log.damaged(spark, snap).count() == 0
    # the same batch again clashes with the store and writes nothing
    v2, written2, _ = jobs.load(spark, final_bundle, store)
    assert written2 == []
    assert v2.filter("rule = 'primary_key_store'").count() > 0
    assert log.read(spark, store, "site").count() == n_sites

    # products of the loaded year go out as a release
    years = [r.year for r in log.read(spark, store, "meta").select("year").collect()]
    rel = scratch_path(spark, "wf-release")
    river = spark.createDataFrame([("GR", "Green"), ("CO", "Colorado"), ("SJ", "San Juan")], "rvr_code string, rvr_name string")
    spp = t.tbl_spp.select("spp_code", "com_name", "sci_name")
    out = jobs.release(spark, store, rel, "building", years[0], river, t.tbl_reach, spp,
                       stage_bounds=t.stage_bounds)
    assert set(out) == {"site", "fish", "floy", "cpue", "cpue_ls"}
    fish_cols = spark.read.option("header", True).csv(out["fish"]).columns
    assert fish_cols[:4] == ["fish_id", "site_id", "datetime", "rmi"] and "pit_notes" in fish_cols
    n_site = spark.read.option("header", True).csv(out["site"]).count()
    assert n_site == site.filter(F.col("year") == years[0]).count()


def test_report_jobs(spark):
    from shoalkit.operators.profile import SITE_LABELS
    from shoalkit.queries_products import fish_with_utm
    from shoalkit.queries_warehouse import wh_tables
    t = tables(spark, SF_SMALL)
    fish = fish_with_utm(t.fish)
    checks = jobs.data_checks(t.site, fish, t.pittag, t.floytag, t.tbl_river, t.tbl_reach, t.water_qual,
                              t.meta, t.tbl_spp.select("spp_code", "com_name", "sci_name"), 1998)
    for name, df in checks.items():
        assert df.count() >= 0, name
    assert checks["stats"].count() > 0
    upd = jobs.update_summary(t.site, fish, 1998)
    assert set(upd) == {"cpue", "cpue_reach", "length_stats", "length_freq", "map_points"}
    assert upd["cpue"].count() > 0 and upd["map_points"].count() > 0
    book = jobs.codebook(spark, t.site, SITE_LABELS)
    assert book["profile"].count() == len(t.site.columns)
    assert {r.column: r.description for r in book["labels"].collect()}["el_sec"] == "Electrofishing time"
    bounds = t.reach_bounds.join(t.tbl_reach.select("rch_code", "rvr_code"), "rch_code")
    out = jobs.warehouse_export(spark, wh_tables(t), 1998, "123d", bounds, t.tbl_reach,
                                scratch_path(spark, "wh-export"))
    assert spark.read.option("header", True).csv(out["fish"]).count() > 0


def test_extract_and_load_without_tag_families(spark, tmp_path):
    t = tables(spark, SF_SMALL)
    site = t.raw_site.filter(F.col("project") == "BUILDING")
    keys = site.select("key_a")
    write_dbf(site, str(tmp_path), "site", prefix="b")
    write_dbf(t.raw_fish.join(keys, "key_a", "left_semi"), str(tmp_path), "fish", prefix="b")
    paths = jobs.extract(spark, str(tmp_path), scratch_path(spark, "wf2-store"), scratch_path(spark, "wf2-b"),
                         "x", PEOPLE, t.tbl_reach)
    assert set(paths) == {"meta", "ck_site", "stats", "ck_fish"}
    v, written, _ = jobs.load(spark, paths["ck_site"].rsplit("/", 1)[0], scratch_path(spark, "wf2-store"))
    assert written == [] and v.count() > 0  # refused (unproofed) but runs without tag sheets
