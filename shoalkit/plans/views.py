"""Reporting views: the site, rare-fish and non-tagged-fish datasheets.

Each is a lazy DataFrame (register it with ``createOrReplaceTempView`` to query it by
name). Tables are joined by key and left to Catalyst/AQE; every column of the datasheet
comes out, so a table that lacks one fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


RARE_SPECIES = ["CS", "RZ", "HB", "BT"]


def _biologist():
    # SQL ``lname || ', ' || fname``: NULL when either part is NULL
    return F.concat(F.col("principal_lname"), F.lit(", "), F.col("principal_fname"))


def view_site(site: DataFrame, meta: DataFrame, water: DataFrame) -> DataFrame:
    """site LEFT JOIN meta ON (project_code, year) LEFT JOIN water_qual ON site_id."""
    m = meta.select("project_code", "year", "agency", "principal_lname", "principal_fname")
    w = water.select("site_id", "cond_amb", "rvr_temp", "secchi")
    j = site.join(m, ["project_code", "year"], "left").join(w, "site_id", "left")
    return j.select(
        F.col("year"), F.col("agency").alias("AGENCY"), _biologist().alias("PROJECT BIOLOGIST"),
        F.col("project_code").alias("PROGRAM"), F.col("river").alias("RIVER"), F.col("reach").alias("REACH"),
        F.col("site_id").alias("SAMPLE NUMBER"), F.col("pass").alias("PASS"), F.lit("EL").alias("GEAR"),
        F.col("start_rmi").alias("STARTRMI"), F.col("end_rmi").alias("ENDRMI"),
        F.col("startdatetime").alias("STARTDATETIME"), F.col("enddatetime").alias("ENDDATETIME"),
        F.col("shoreline").alias("SHORELINE"), F.col("el_sec").alias("EL SEC"), F.col("boat").alias("BOAT"),
        F.col("cond_amb").alias("CONDUCTIVITY"), F.col("crew").alias("CREW"),
        F.col("rvr_temp").alias("RIVER TEMP"), F.col("secchi").alias("TURBIDITY"))


def _fish_site_meta(fish: DataFrame, site: DataFrame, meta: DataFrame) -> DataFrame:
    s = site.select(F.col("site_id").alias("_site_id"), "year", "river")
    # meta joins on year only (as the view is written): one meta row per year
    m = meta.select("year", "agency", "principal_lname", "principal_fname")
    return fish.join(s, fish["site_id"] == s["_site_id"], "left").join(m, "year", "left")


def _fish_cols(j: DataFrame):
    return [F.col("agency").alias("AGENCY"), _biologist().alias("PROJECT BIOLOGIST"),
            F.col("river").alias("RIVER"), F.col("rmi").alias("RMI"), F.col("year").alias("YEAR"),
            F.col("datetime").alias("DATE TIME"), F.col("_site_id").alias("SAMPLE NUMBER"),
            F.col("species").alias("SPECIES"), F.col("tot_length").alias("LENGTH"),
            F.col("weight").alias("WEIGHT"), F.col("sex").alias("SEX"), F.col("rep_cond").alias("RIPE")]


def view_rare(fish: DataFrame, site: DataFrame, meta: DataFrame, pit: DataFrame) -> DataFrame:
    """Rare species or tagged fish (fish x site x meta-by-year x pittag)."""
    p = pit.select("fish_id", "pit_type", "pit_num", "pit_recap")
    j = _fish_site_meta(fish, site, meta).join(p, "fish_id", "left")
    j = j.filter(F.col("species").isin(RARE_SPECIES) | F.col("pit_num").isNotNull())
    return j.select(F.col("pit_type"), F.col("pit_num"), *_fish_cols(j),
                    F.col("tubercles").alias("TUBERCLES"), F.col("ray_ct").alias("RAYS"),
                    F.col("pit_recap").alias("RECAPTURE"), F.col("disp").alias("DISP"),
                    F.lit("EL").alias("GEAR"), "epsg", F.col("loc_x").alias("UTM X"),
                    F.col("loc_y").alias("UTM Y"))


def view_ntf(fish: DataFrame, site: DataFrame, meta: DataFrame, floy: DataFrame, pit: DataFrame) -> DataFrame:
    """Untagged fish of other species: ``pit_num IS NULL AND species NOT IN (rare)``.

    Written as the view is (left joins + filter), not as an anti-join: a tag row with a
    NULL number still counts as untagged. A NULL species passes neither view.
    """
    fl = floy.select("fish_id", "floy_id", "floy_num", "floy_color", "floy_recap", "floy_ref")
    p = pit.select("fish_id", "pit_num")
    j = _fish_site_meta(fish, site, meta).join(fl, "fish_id", "left").join(p, "fish_id", "left")
    j = j.filter(F.col("pit_num").isNull() & ~F.col("species").isin(RARE_SPECIES))
    return j.select(*_fish_cols(j), "floy_id", "floy_num", "floy_color", "floy_recap", "floy_ref",
                    F.col("disp").alias("DISP"), F.lit("EL").alias("GEAR"), "epsg",
                    F.col("loc_x").alias("UTM X"), F.col("loc_y").alias("UTM Y"), "pit_num")


def register_views(site: DataFrame, meta: DataFrame, water: DataFrame, fish: DataFrame,
                   pit: DataFrame, floy: DataFrame, prefix: str = "vw_") -> dict:
    """Create the three datasheets as temp views (``vw_site``, ``vw_rare``, ``vw_ntf``)
    so they can be queried by name with ``spark.sql``."""
    views = {"site": view_site(site, meta, water), "rare": view_rare(fish, site, meta, pit),
             "ntf": view_ntf(fish, site, meta, floy, pit)}
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return views
