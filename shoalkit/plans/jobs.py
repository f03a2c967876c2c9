"""Workflows as the reference runs them, composed from the library's operators.

* ``extract``  capture files (dBase folder) -> keyed, cleaned, rule-flagged tables ->
               proofing bundle (one CSV folder per sheet, with its schema).
* ``load``     proofed bundle -> validated batch -> store append (all or nothing) ->
               snapshot of the store.
* ``release``  store -> data products of a project-year -> gzip CSV release.

Each step stays lazy until its sink; the only driver round trips are the next site
number and upload id (one number each) and the bounded lists noted in the operators.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as qc
from ..operators.aggregate import next_number
from ..session import ensure_checkpoint_dir
from ..sources.dbf import read_dbf
from ..sources.files import path_exists, read_bundle_sheet
from ..sources.sinks import snapshot_store, write_bundle, write_release
from . import effort, etl, load as loader, products

FAMILIES = ("site", "water", "fish", "pittag", "floytag", "vial")
SHEETS = {"meta": "meta", "ck_site": "site", "water": "water_qual", "ck_fish": "fish", "ck_pit": "pittag",
          "ck_floy": "floytag"}


def next_site_number(store: dict) -> int:
    """1 + the largest numeric suffix of the stored site ids (1 for an empty store)."""
    site = store.get("site")
    if site is None:
        return 1
    return int(next_number(site, "site_id", r"(\d+)$").first()[0])


def extract(spark: SparkSession, capture_dir: str, store_root: str, bundle_root: str, data_id: str,
            people: dict, reach_dim: DataFrame, stats_species=("SM",)) -> dict:
    """Raw capture files -> proofing bundle ``<bundle_root>/<data_id>_raw``.

    ``people``: principal_fname, principal_lname, agency, data_type for the meta row.
    """
    ensure_checkpoint_dir(spark)
    raw = {fam: read_dbf(spark, capture_dir, family=fam) for fam in FAMILIES}
    raw = {fam: df for fam, df in raw.items() if df.columns}  # a family with no files is absent
    store = loader.read_store_tables(spark, store_root)
    site = etl.build_site(raw["site"], reach_dim, next_site_number(store)).checkpoint()
    samp_n = etl.key_map(site)
    named = {"meta": etl.meta_rows(raw["site"], **people), "ck_site": qc.site_qc(site)}
    fish = None
    if "fish" in raw:
        fish = etl.build_fish(raw["fish"], samp_n).checkpoint()
        named["stats"] = effort.effort_stats(site, fish, stats_species, ["pass"])
        named["ck_fish"] = qc.fish_qc(fish, site)
    if fish is not None and "pittag" in raw:
        named["ck_pit"] = qc.pit_qc(etl.build_tags(raw["pittag"], samp_n, fish, "pit"), fish)
    if fish is not None and "floytag" in raw:
        named["ck_floy"] = qc.floy_qc(etl.build_tags(raw["floytag"], samp_n, fish, "floy"))
    if "water" in raw:
        named["water"] = etl.build_water(raw["water"], samp_n)
    if "vial" in raw:
        named["vial"] = etl.build_vial(raw["vial"])
    return write_bundle(named, f"{bundle_root.rstrip('/')}/{data_id}_raw")


def load(spark: SparkSession, bundle: str, store_root: str, archive_root: str | None = None,
         date: str | None = None):
    """Proofed bundle -> store. Returns ``(violations, written_tables, snapshot_path)``."""
    proofed = {}
    for sheet, table in SHEETS.items():
        if path_exists(spark, f"{bundle.rstrip('/')}/{sheet}._schema"):  # else the batch had no such table
            proofed[table] = read_bundle_sheet(spark, bundle, sheet)
    violations, written, upload_id = loader.load_batch(spark, proofed, store_root, conform_tables=True,
                                                       number_meta=True)
    snap = None
    if written and archive_root:
        snap = snapshot_store(spark, store_root, archive_root, date or _dt.date.today().strftime("%Y%m%d"), upload_id)
    return violations, written, snap


def release(spark: SparkSession, store_root: str, out: str, project: str, year: int, river: DataFrame,
            reach: DataFrame, species: DataFrame, stage_bounds: DataFrame | None = None,
            daily: DataFrame | None = None, stations: DataFrame | None = None, as_of=None) -> dict:
    """Store -> site, fish, floy, CPUE (and water) products of one project-year."""
    st = loader.read_store_tables(spark, store_root)
    site_p = products.site_pointer(st["site"], river, reach, st["water_qual"], st["meta"], [year])
    named = {
        "site": products.site_product(st["site"], river, reach, st["water_qual"], st["meta"], [year], as_of),
        "fish": products.fish_product(st["fish"], site_p, st["pittag"], species),
        "floy": products.floy_product(st["floytag"]),
        "cpue": effort.cpue(st["site"], st["fish"], [year], as_of),
    }
    if stage_bounds is not None:
        named["cpue_ls"] = effort.cpue_life_stage(st["site"], st["fish"], stage_bounds, ["SM"], [year], as_of)
    if daily is not None and stations is not None:
        named["usgswater"] = products.water_product(daily, stations, year, as_of=as_of)
    return write_release(named, out, project, year)


def warehouse_export(spark: SparkSession, tables: dict, year: int, project: str, reach_bounds: DataFrame,
                     reach_dim: DataFrame, out: str, as_of=None) -> dict:
    """Normalised warehouse -> site and fish CSV products of one project-year."""
    from ..sources.sinks import write_product
    from . import warehouse as wh
    site_p = wh.site_pointer(tables, year, project)
    site = wh.wh_site(tables, year, project, reach_bounds, reach_dim, as_of)
    fish = wh.wh_fish(wh.wh_rare(tables, site_p), wh.wh_untagged(tables, site_p))
    return {"site": write_product(site, f"{out.rstrip('/')}/{project}_{year}_site_STR"),
            "fish": write_product(fish, f"{out.rstrip('/')}/{project}_{year}_fish_STR")}


def data_checks(site: DataFrame, fish: DataFrame, pit: DataFrame, floy: DataFrame, river: DataFrame,
                reach: DataFrame, water: DataFrame, meta: DataFrame, species: DataFrame, year: int) -> dict:
    """The quick-stats tables of one year: effort by reach and pass, mile and time
    histograms by reach, fish and tag tables, tagged fish by species, SM lengths."""
    from ..operators.distribution import bar_counts, histogram
    site_y = site.filter(F.col("year") == year)
    fish_y = fish.join(site_y.select("site_id"), "site_id", "inner")
    site_p = products.site_pointer(site, river, reach, water, meta, [year])
    site_tbl = products.site_product(site, river, reach, water, meta, [year])
    fish_tbl = products.fish_product(fish, site_p, pit, species, with_site=True)
    return {
        "stats": effort.effort_stats(site_y, fish_y, ["SM"], ["reach", "pass"], catch_name="SM", species_col=None),
        "start_rmi_hist": histogram(site_tbl, "start_rmi", width=5, by=["rch_code"]),
        "end_rmi_hist": histogram(site_tbl, "end_rmi", width=5, by=["rch_code"]),
        "start_time_hist": histogram(site_tbl.withColumn("t", F.unix_micros(F.col("startdatetime").cast("timestamp"))),
                                     "t", bins=30, by=["rch_code"], per_group_range=True),
        "fish_rmi_hist": histogram(fish_tbl, "rmi", bins=30),
        "tagged_by_species": bar_counts(fish_tbl.filter(F.col("pit_num").isNotNull()), "spp_code"),
        "sm_length_hist": histogram(fish_tbl.filter(F.col("spp_code") == "SM"), "tot_length", bins=30),
        "tag_list": products.tag_list(fish_tbl),
        "floy": products.floy_product(floy, fish_tbl.select("fish_id", "spp_code", "rmi", "rch_code")),
    }


def update_summary(site: DataFrame, fish: DataFrame, year: int, species: str = "SM") -> dict:
    """The annual update tables: CPUE by pass/reach/species, one species by reach,
    length statistics and length frequency by reach, map points."""
    from ..operators.aggregate import length_stats
    from ..operators.distribution import histogram
    site_y = site.filter(F.col("year") == year)
    fish_y = fish.join(site_y.select("site_id"), "site_id", "left_semi")
    cpue_tbl = effort.cpue_by(site_y, fish_y)
    lf = fish_y.join(site_y.select("site_id", "pass", "reach"), "site_id", "left").filter(F.col("species") == species)
    return {
        "cpue": cpue_tbl,
        "cpue_reach": effort.cpue_rollup(cpue_tbl, species),
        "length_stats": length_stats(lf, ["reach"], "tot_length", prefix="tl"),
        "length_freq": histogram(lf, "tot_length", bins=30, by=["reach"]),
        "map_points": products.map_points(fish_y, site_y, species),
    }


def codebook(spark: SparkSession, df: DataFrame, labels: dict | None = None) -> dict:
    """Column profile and labels of a product (the codebook's tables)."""
    from ..operators.profile import labels_table, profile, with_labels
    labelled = with_labels(df, labels or {})
    return {"profile": profile(labelled, quantiles=(0.25, 0.5, 0.75)), "labels": labels_table(spark, labelled)}
