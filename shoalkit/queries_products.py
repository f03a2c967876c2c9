"""Queries: reporting views and data products."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import AS_OF_SQL, T, W, YEARS, register
from .functions.geo import EPSG_UTM12N, utm_sql, utm_xy
from .plans import effort, products, views
from .queries_relational import _ROLLUP_SQL, year_tables
from .session import scratch_path
from .sources.daily import read_daily, write_daily

_Y = ", ".join(str(y) for y in YEARS)
WATER_YEAR = 2024
_BIO = "m.principal_lname || ', ' || m.principal_fname"

# ================================================================ views
register("vw_site", W("site", "meta", "water_qual") + f"""
SELECT s.year, m.agency AS "AGENCY", {_BIO} AS "PROJECT BIOLOGIST", s.project_code AS "PROGRAM",
  s.river AS "RIVER", s.reach AS "REACH", s.site_id AS "SAMPLE NUMBER", s.pass AS "PASS", 'EL' AS "GEAR",
  s.start_rmi AS "STARTRMI", s.end_rmi AS "ENDRMI", s.startdatetime AS "STARTDATETIME", s.enddatetime AS "ENDDATETIME",
  s.shoreline AS "SHORELINE", s.el_sec AS "EL SEC", s.boat AS "BOAT",
  w.cond_amb AS "CONDUCTIVITY", s.crew AS "CREW", w.rvr_temp AS "RIVER TEMP", w.secchi AS "TURBIDITY"
FROM site s LEFT JOIN meta m ON s.project_code = m.project_code AND s.year = m.year
LEFT JOIN water_qual w ON s.site_id = w.site_id""")(
    lambda spark, d: views.view_site(T(spark, d).site, T(spark, d).meta, T(spark, d).water_qual))

_FISH_COLS = f"""m.agency AS "AGENCY", {_BIO} AS "PROJECT BIOLOGIST", s.river AS "RIVER", f.rmi AS "RMI",
  s.year AS "YEAR", f.datetime AS "DATE TIME", s.site_id AS "SAMPLE NUMBER", f.species AS "SPECIES",
  f.tot_length AS "LENGTH", f.weight AS "WEIGHT", f.sex AS "SEX", f.rep_cond AS "RIPE\""""

_UTM = 'f.epsg, f.loc_x AS "UTM X", f.loc_y AS "UTM Y"'

register("vw_rare", W("site", "fish", "meta", "pittag") + f"""
SELECT p.pit_type, p.pit_num, {_FISH_COLS}, f.tubercles AS "TUBERCLES", f.ray_ct AS "RAYS", p.pit_recap AS "RECAPTURE",
  f.disp AS "DISP", 'EL' AS "GEAR", {_UTM}
FROM fish f LEFT JOIN site s ON s.site_id = f.site_id LEFT JOIN meta m ON s.year = m.year
LEFT JOIN pittag p ON f.fish_id = p.fish_id
WHERE f.species IN ('CS', 'RZ', 'HB', 'BT') OR p.pit_num IS NOT NULL""")(
    lambda spark, d: views.view_rare(T(spark, d).fish, T(spark, d).site, T(spark, d).meta, T(spark, d).pittag))

register("vw_ntf", W("site", "fish", "meta", "pittag", "floytag") + f"""
SELECT {_FISH_COLS}, fl.floy_id, fl.floy_num, fl.floy_color, fl.floy_recap, fl.floy_ref, f.disp AS "DISP", 'EL' AS "GEAR", {_UTM}, p.pit_num
FROM fish f LEFT JOIN site s ON s.site_id = f.site_id LEFT JOIN meta m ON s.year = m.year
LEFT JOIN floytag fl ON f.fish_id = fl.fish_id LEFT JOIN pittag p ON f.fish_id = p.fish_id
WHERE p.pit_num IS NULL AND f.species NOT IN ('CS', 'RZ', 'HB', 'BT')""")(
    lambda spark, d: views.view_ntf(T(spark, d).fish, T(spark, d).site, T(spark, d).meta,
                                    T(spark, d).floytag, T(spark, d).pittag))

# ================================================================ products
_META_SQL = f"""SELECT year, project_code, concat_ws(', ', principal_lname, principal_fname) AS principal,
  agency, data_type AS gear_type FROM meta WHERE year IN ({_Y})"""
register("dp_meta", W("meta") + _META_SQL)(lambda spark, d: products.meta_product(T(spark, d).meta, YEARS))


def site_p(t):
    return products.site_pointer(t.site, t.tbl_river, t.tbl_reach, t.water_qual, t.meta, YEARS)


_SITE_P_SQL = f"""
, mp AS ({_META_SQL})
, sp AS (SELECT s.site_id, s.project_code, s.year, rv.rvr_name, rc.rch_name, s.key_a, s.river AS rvr_code,
    s.reach AS rch_code, s.pass, s.startdatetime, s.enddatetime, s.shoreline, s.el_sec, s.elapsed_sec, s.start_rmi,
    s.end_rmi, s.boat, s.crew, s.site_notes, s.upload_id, w.cond_amb, w.cond_spec, w.rvr_temp, w.secchi, w.water_notes, mp.principal, mp.agency, mp.gear_type
  FROM site s LEFT JOIN tbl_river rv ON s.river = rv.rvr_code LEFT JOIN tbl_reach rc ON s.reach = rc.rch_code
  LEFT JOIN water_qual w ON s.site_id = w.site_id JOIN mp ON s.project_code = mp.project_code AND s.year = mp.year)"""
_SITE_P_TABLES = ("site", "meta", "tbl_river", "tbl_reach", "water_qual")

register("dp_site", W(*_SITE_P_TABLES) + _SITE_P_SQL + f"""
SELECT *, {AS_OF_SQL} AS last_modified FROM sp""")(
    lambda spark, d: products.site_product(T(spark, d).site, T(spark, d).tbl_river, T(spark, d).tbl_reach,
                                           T(spark, d).water_qual, T(spark, d).meta, YEARS))

_RIPE = "CASE WHEN regexp_matches(f.rep_cond, '^INT+') THEN 'N' WHEN regexp_matches(f.rep_cond, '^EXP+') THEN 'Y' END"
register("dp_fish", W(*_SITE_P_TABLES, "fish", "pittag", "tbl_spp") + _SITE_P_SQL + f"""
SELECT f.fish_id, f.site_id, f.key_a, f.datetime, f.rmi, f.species AS spp_code, t.com_name, t.sci_name,
  f.tot_length, f.weight, f.sex, {_RIPE} AS ripe, f.tubercles, f.ray_ct, f.disp, f.loc_x, f.loc_y, f.epsg, f.fish_notes,
  p.pit_id, p.pit_type, p.pit_num, p.pit_recap, p.pit_notes
FROM fish f LEFT JOIN pittag p ON f.fish_id = p.fish_id LEFT JOIN tbl_spp t ON f.species = t.spp_code
WHERE f.site_id IN (SELECT site_id FROM sp)""")(
    lambda spark, d: products.fish_product(T(spark, d).fish, site_p(T(spark, d)), T(spark, d).pittag,
                                           T(spark, d).tbl_spp))


def _q_tag_list(spark, d):
    t = T(spark, d)
    ft = products.fish_product(t.fish, site_p(t), t.pittag, t.tbl_spp, with_site=True)
    return products.tag_list(ft)


register("dp_tag_list", W(*_SITE_P_TABLES, "fish", "pittag", "tbl_spp") + _SITE_P_SQL + """
SELECT f.species AS spp_code, sp.rch_code, f.datetime, f.rmi, p.pit_num, p.pit_recap, p.pit_type
FROM fish f LEFT JOIN sp ON f.site_id = sp.site_id JOIN pittag p ON f.fish_id = p.fish_id""")(_q_tag_list)


def _q_floy(spark, d):
    t = T(spark, d)
    info = (t.fish.select("fish_id", F.col("species").alias("spp_code"), "rmi", "site_id")
            .join(t.site.select("site_id", F.col("reach").alias("rch_code")), "site_id", "left").drop("site_id"))
    return products.floy_product(t.floytag, info)


register("dp_floy", W("floytag", "fish", "site") + """
SELECT fl.*, f.species AS spp_code, f.rmi, s.reach AS rch_code
FROM floytag fl LEFT JOIN fish f ON fl.fish_id = f.fish_id LEFT JOIN site s ON f.site_id = s.site_id""")(_q_floy)

register("dp_water", W("daily", "stations") + f"""
, d AS (SELECT * FROM daily WHERE date BETWEEN DATE '{WATER_YEAR - 1}-12-31' AND DATE '{WATER_YEAR}-12-31'
        AND staid IN (SELECT staid FROM stations))
, dis AS (SELECT staid, date, avg(val) AS discharge FROM d WHERE code = '00060' AND stat = '00003' GROUP BY staid, date)
, tmp AS (SELECT d.staid, date, avg(val) AS temp FROM d JOIN stations s ON d.staid = s.staid
          WHERE code = '00010' AND stat = s.temp_stat GROUP BY d.staid, date)
, j AS (SELECT coalesce(dis.staid, tmp.staid) AS staid, coalesce(dis.date, tmp.date) AS date, discharge, temp
        FROM dis FULL JOIN tmp ON dis.staid = tmp.staid AND dis.date = tmp.date)
SELECT j.*, st.sta_name, st.rvr_code, {AS_OF_SQL} AS last_modified FROM j LEFT JOIN stations st ON j.staid = st.staid""")(
    lambda spark, d: products.water_product(T(spark, d).daily, T(spark, d).stations, WATER_YEAR))

def _q_daily(spark, d):
    """Daily values landed as station text, read back, one parameter and statistic of one station."""
    landed = (T(spark, d).daily.filter(F.col("code") != "other").groupBy("staid", "date", "code", "stat")
              .agg(F.avg("val").alias("val"), F.max("qualcode").alias("qualcode")))
    got = read_daily(spark, write_daily(landed, scratch_path(spark, "daily")))
    return products.daily_values(got, "09261000", "00060", "00003", f"{WATER_YEAR - 1}-12-31", f"{WATER_YEAR}-12-31", "discharge")


register("src_daily_values", W("daily") + f"""
SELECT staid, date, avg(val) AS discharge FROM daily WHERE staid = '09261000' AND code = '00060' AND stat = '00003'
  AND date BETWEEN DATE '{WATER_YEAR - 1}-12-31' AND DATE '{WATER_YEAR}-12-31' GROUP BY staid, date""")(_q_daily)

register("dp_cpue_life_stage", W("site", "fish", "stage_bounds") + f"""
, s AS (SELECT site_id, el_sec, river AS rvr_code, reach AS rch_code, startdatetime FROM site WHERE year IN ({_Y}))
, t AS (SELECT site_id, species, tot_length FROM fish WHERE species IN ('SM'))
, st AS (SELECT t.site_id, t.species || '_' || coalesce(b.life_stage, 'NA') AS ls FROM t
         LEFT JOIN stage_bounds b ON t.species = b.species AND t.tot_length >= b.min_len AND t.tot_length < b.max_len)
, c AS (SELECT st.site_id, st.ls, count(*) AS n FROM st JOIN s ON st.site_id = s.site_id GROUP BY st.site_id, st.ls)
, v AS (SELECT DISTINCT ls FROM c)
SELECT s.site_id, s.el_sec, s.rvr_code, s.rch_code, s.startdatetime, split_part(v.ls, '_', 1) AS spp_code,
  split_part(v.ls, '_', 2) AS life_stage, coalesce(c.n, 0) AS fish_ct,
  round_even(CASE WHEN s.el_sec = 0 THEN NULL ELSE coalesce(c.n, 0) / (s.el_sec / 3600) END, 2) AS cpue,
  {AS_OF_SQL} AS last_modified
FROM s CROSS JOIN v LEFT JOIN c ON c.site_id = s.site_id AND c.ls = v.ls""")(
    lambda spark, d: effort.cpue_life_stage(T(spark, d).site, T(spark, d).fish, T(spark, d).stage_bounds,
                                            ["SM"], YEARS))

register("dp_update_cpue", W("site", "fish") + _ROLLUP_SQL + """
SELECT pass, reach, species, effort, catch,
  round_even(CASE WHEN effort = 0 THEN NULL ELSE catch / effort END, 2) AS cpue FROM fc""")(
    lambda spark, d: effort.cpue_by(*year_tables(T(spark, d))))

register("dp_year_fish", W("site", "fish") + f"""
SELECT f.*, s.project_code, s.year, s.river, s.reach, s.pass, s.startdatetime, s.enddatetime, s.shoreline, s.el_sec,
  s.elapsed_sec, s.start_rmi, s.end_rmi, s.boat, s.crew, s.site_notes, s.upload_id, s.key_a AS key_a_site
FROM fish f JOIN site s ON f.site_id = s.site_id WHERE s.year IN ({_Y})""")(
    lambda spark, d: products.year_fish(T(spark, d).site, T(spark, d).fish, YEARS))


def fish_with_utm(fish):
    x, y = utm_xy("ilon", "ilat")
    has = F.col("ilon").isNotNull() & F.col("ilat").isNotNull()
    return fish.withColumns({"loc_x": F.when(has, x), "loc_y": F.when(has, y),
                             "epsg": F.when(has, F.lit(EPSG_UTM12N))})


_UX, _UY = utm_sql("ilon", "ilat")
register("dp_map_points", W("fish", "site") + f"""
, fu AS (SELECT * EXCLUDE (loc_x, loc_y, epsg), {_UX} AS loc_x, {_UY} AS loc_y, CASE WHEN ilon IS NOT NULL AND ilat IS NOT NULL THEN {EPSG_UTM12N} END AS epsg
         FROM fish WHERE ilon IS NOT NULL AND ilat IS NOT NULL)
SELECT f.rmi, f.species, s.pass, f.epsg, count(*) AS fish_count, avg(f.loc_x) AS loc_x, avg(f.loc_y) AS loc_y
FROM fu f LEFT JOIN site s ON f.site_id = s.site_id WHERE f.species = 'SM' GROUP BY f.rmi, f.species, s.pass, f.epsg""")(
    lambda spark, d: products.map_points(fish_with_utm(T(spark, d).fish), T(spark, d).site, "SM"))

register("geo_utm", W("fish") + f"""
SELECT fish_id, ilon, ilat, {_UX} AS loc_x, {_UY} AS loc_y FROM fish WHERE ilon IS NOT NULL""")(
    lambda spark, d: T(spark, d).fish.filter(F.col("ilon").isNotNull()).select(
        "fish_id", "ilon", "ilat", *[c.alias(n) for c, n in zip(utm_xy("ilon", "ilat"), ("loc_x", "loc_y"))]))
