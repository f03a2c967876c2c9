"""Queries: cleaning, projections, scalar functions and the raw-to-keyed ETL
(SURVEY 2.1 scans over families, 2.2, 2.8, 2.12 *_etl rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import T, W, register
from .functions.geo import utm_sql
from .functions.nulls import r_round, sub_first
from .operators import clean
from .operators import projection as prj
from .operators import quality as qc
from .operators.quality import NATIVE
from .plans import etl, products
from .queries_quality import SITE_QC_SQL, site_input
from .session import sealed
from .sources.files import union_family

_NATIVE = ", ".join(f"'{s}'" for s in NATIVE)
_TS = "'%m/%d/%Y %H:%M:%S'"

# ------------------------------------------------------------------ oracle building blocks
RAW_SITE_CLEAN = """
, rs AS (SELECT key_a, nullif(project, 'Z') AS project, nullif(date, 'Z') AS date, nullif(starttime, 'Z') AS starttime,
    nullif(endtime, 'Z') AS endtime, effort_min, effort_sec, nullif(reach, 'Z') AS reach, pass, start_rmi, end_rmi,
    nullif(shoreline, 'Z') AS shoreline, nullif(boat, 'Z') AS boat, nullif(crew, 'Z') AS crew,
    nullif(site_notes, 'Z') AS site_notes FROM raw_site)"""

SITE_ETL_SQL = RAW_SITE_CLEAN + f"""
, rp AS (SELECT *, try_strptime(date || ' ' || starttime, {_TS}) AS startdatetime,
    try_strptime(date || ' ' || endtime, {_TS}) AS enddatetime, effort_sec + effort_min * 60 AS el_sec FROM rs)
, ri AS (SELECT *, row_number() OVER (ORDER BY startdatetime ASC NULLS LAST, key_a) AS s_index FROM rp)
, se AS (SELECT s_index,
    coalesce(lower(project), 'NA') || '_' || coalesce(CAST(year(startdatetime) AS VARCHAR), 'NA') || '_' || printf('%03d', s_index) AS site_id,
    lower(project) AS project, CAST(year(startdatetime) AS INTEGER) AS year, t.rvr_code AS river, ri.reach, pass,
    startdatetime, enddatetime,
    CASE WHEN ri.reach IN ('DESO', 'ECHO') THEN start_rmi + 120 ELSE start_rmi END AS start_rmi,
    CASE WHEN ri.reach IN ('DESO', 'ECHO') THEN end_rmi + 120 ELSE end_rmi END AS end_rmi,
    shoreline, el_sec, boat, crew, site_notes, key_a
  FROM ri LEFT JOIN tbl_reach t ON ri.reach = t.rch_code)
, km AS (SELECT key_a, site_id, startdatetime AS t_stamp, reach FROM se)"""

_UX, _UY = utm_sql("ilon", "ilat")
FISH_ETL_SQL = SITE_ETL_SQL + f"""
, fr AS (SELECT key_aa, key_a, time, rmi, nullif(species, 'Z') AS species, nullif(tot_length, 0) AS tot_length,
    nullif(st_length, 0) AS st_length, nullif(weight, 0) AS weight, nullif(sex, 'Z') AS sex,
    upper(nullif(rep_cond, 'Z')) AS rep_cond,
    CASE WHEN nullif(species, 'Z') IN ({_NATIVE}) THEN nullif(tubercles, 'Z') END AS tubercles,
    nullif(nullif(ray_ct, 'Z'), 'N') AS ray_ct, nullif(disp, 'Z') AS disp, nullif(fish_notes, 'Z') AS fish_notes,
    nullif(ilon, 0) AS ilon, nullif(ilat, 0) AS ilat FROM raw_fish)
, fj AS (SELECT fr.*, k.site_id, k.reach,
    try_strptime(strftime(k.t_stamp, '%Y-%m-%d') || ' ' || fr.time, '%Y-%m-%d %H:%M:%S') AS datetime
  FROM fr LEFT JOIN km k ON fr.key_a IS NOT DISTINCT FROM k.key_a)
, f1 AS (SELECT row_number() OVER (ORDER BY datetime ASC NULLS LAST, key_aa, tot_length NULLS LAST, weight NULLS LAST,
    st_length NULLS LAST) AS f_index, key_aa AS fish_id, site_id, reach,
    CASE WHEN reach IN ('DESO', 'ECHO') THEN rmi + 120 ELSE rmi END AS rmi, datetime, species, tot_length, weight,
    sex, rep_cond, tubercles, ray_ct, disp, fish_notes, key_a, ilon, ilat FROM fj)
, pts AS (SELECT site_id, rmi, avg(ilon) AS ilon, avg(ilat) AS ilat FROM f1 GROUP BY site_id, rmi HAVING avg(ilon) IS NOT NULL)
, u AS (SELECT site_id, rmi, {_UX} AS loc_x, {_UY} AS loc_y, 32612 AS epsg FROM pts)
, fe AS (SELECT f1.f_index, f1.fish_id, f1.site_id, f1.reach, f1.rmi, f1.datetime, f1.species, f1.tot_length, f1.weight,
    f1.sex, f1.rep_cond, f1.tubercles, f1.ray_ct, f1.disp, f1.fish_notes, f1.key_a, u.loc_x, u.loc_y, u.epsg
  FROM f1 LEFT JOIN u ON f1.site_id IS NOT DISTINCT FROM u.site_id AND f1.rmi IS NOT DISTINCT FROM u.rmi)"""


def _site(t):
    return etl.build_site(t.raw_site, t.tbl_reach)


def _keys(t):
    """The key map as files: child tables join it several times."""
    return sealed(etl.key_map(etl.build_site(t.raw_site, t.tbl_reach, columns=etl.KEY_COLUMNS)), "key-map")


def _fish(t, samp_n=None):
    samp_n = samp_n if samp_n is not None else _keys(t)
    return etl.build_fish(t.raw_fish, samp_n)


# ------------------------------------------------------------------ ETL tables
register("dp_site_etl", W("raw_site", "tbl_reach") + SITE_ETL_SQL + "\nSELECT * FROM se")(
    lambda spark, d: _site(T(spark, d)))

register("dp_key_map", W("raw_site", "tbl_reach") + SITE_ETL_SQL + "\nSELECT * FROM km")(
    lambda spark, d: etl.key_map(_site(T(spark, d))))

register("dp_water_etl", W("raw_site", "tbl_reach", "raw_water") + SITE_ETL_SQL + """
, wr AS (SELECT key_ab, key_a, nullif(cond_amb, 0) AS cond_amb, nullif(cond_spec, 0) AS cond_spec,
    nullif(rvr_temp, 0) AS rvr_temp, nullif(secchi, 0) AS secchi, nullif(h2o_notes, 'Z') AS h2o_notes FROM raw_water)
SELECT wr.key_ab AS water_id, k.site_id, cond_amb, cond_spec, rvr_temp, secchi, h2o_notes AS water_notes, wr.key_a
FROM wr LEFT JOIN km k ON wr.key_a IS NOT DISTINCT FROM k.key_a""")(
    lambda spark, d: etl.build_water(T(spark, d).raw_water, etl.key_map(_site(T(spark, d)))))

register("dp_fish_etl", W("raw_site", "tbl_reach", "raw_fish") + FISH_ETL_SQL + "\nSELECT * FROM fe")(
    lambda spark, d: _fish(T(spark, d)))


def _q_tags(kind):
    def q(spark, d):
        t = T(spark, d)
        samp_n = _keys(t)
        fish = etl.fish_times(t.raw_fish, samp_n)
        raw = t.raw_pittag if kind == "pit" else t.raw_floytag
        return etl.build_tags(raw, samp_n, fish, kind)
    return q


register("dp_pit_etl", W("raw_site", "tbl_reach", "raw_fish", "raw_pittag") + FISH_ETL_SQL + """
, pr AS (SELECT key_aaa, key_aa, key_a, nullif(pit_type, 'Z') AS pit_type, nullif(pit_num, 'Z') AS pit_num,
    nullif(pit_recap, 'Z') AS pit_recap, nullif(pit_notes, 'Z') AS pit_notes FROM raw_pittag WHERE pit_num IS NOT NULL)
, pj AS (SELECT pr.key_aaa AS pit_id, pr.key_aa AS fish_id, k.site_id, f.species, pr.pit_type, upper(pr.pit_num) AS pit_num,
    pr.pit_recap, pr.pit_notes, pr.key_a, f.datetime
  FROM pr LEFT JOIN km k ON pr.key_a IS NOT DISTINCT FROM k.key_a
  LEFT JOIN fe f ON pr.key_aa IS NOT DISTINCT FROM f.fish_id)
SELECT row_number() OVER (ORDER BY datetime ASC NULLS LAST, pit_id) AS p_index, pit_id, fish_id, site_id, species,
  pit_type, pit_num, pit_recap, pit_notes, key_a FROM pj""")(_q_tags("pit"))

register("dp_floy_etl", W("raw_site", "tbl_reach", "raw_fish", "raw_floytag") + FISH_ETL_SQL + """
, fl AS (SELECT key_aab, key_aa, key_a, nullif(floy_color, 'Z') AS floy_color, nullif(floy_num, 'Z') AS floy_num,
    nullif(floy_recap, 'Z') AS floy_recap, nullif(floy_notes, 'Z') AS floy_notes FROM raw_floytag WHERE floy_num IS NOT NULL)
, fj2 AS (SELECT fl.key_aab AS floy_id, fl.key_aa AS fish_id, k.site_id, f.species, fl.floy_color, fl.floy_num,
    fl.floy_recap, fl.floy_notes, f.datetime
  FROM fl LEFT JOIN km k ON fl.key_a IS NOT DISTINCT FROM k.key_a
  LEFT JOIN fe f ON fl.key_aa IS NOT DISTINCT FROM f.fish_id)
SELECT row_number() OVER (ORDER BY datetime ASC NULLS LAST, floy_id) AS fl_index, floy_id, fish_id, site_id, species,
  floy_color, floy_num, floy_recap, floy_notes FROM fj2""")(_q_tags("floy"))

register("dp_vial_etl", W("raw_vial") + """
SELECT key_aav, key_aa, key_a, nullif(vial_num, 'Z') AS vial_num, nullif(vial_type, 'Z') AS vial_type,
  nullif(vial_notes, 'Z') AS vial_notes FROM raw_vial""")(lambda spark, d: etl.build_vial(T(spark, d).raw_vial))

register("dp_meta_row", W("raw_site") + RAW_SITE_CLEAN + f"""
SELECT DISTINCT lower(project) AS project_code, CAST(year(try_strptime(date || ' ' || starttime, {_TS})) AS INTEGER) AS year,
  'Pat' AS principal_fname, 'Doe' AS principal_lname, 'UDWR-M' AS agency, 'EL' AS data_type FROM rs""")(
    lambda spark, d: etl.meta_rows(T(spark, d).raw_site, "Pat", "Doe", "UDWR-M", "EL"))

# ------------------------------------------------------------------ cleaning
register("cln_sentinel_null", W("raw_site") + RAW_SITE_CLEAN + "\nSELECT * FROM rs")(
    lambda spark, d: clean.sentinel_to_null(T(spark, d).raw_site))

register("cln_zero_null", W("raw_water") + """
SELECT key_ab, key_a, nullif(cond_amb, 0) AS cond_amb, nullif(cond_spec, 0) AS cond_spec, nullif(rvr_temp, 0) AS rvr_temp,
  nullif(secchi, 0) AS secchi, h2o_notes FROM raw_water""")(
    lambda spark, d: clean.zero_to_null(T(spark, d).raw_water, etl.WATER_ZERO))

register("cln_value_null", W("raw_fish") + "SELECT key_aa, nullif(ray_ct, 'N') AS ray_ct FROM raw_fish")(
    lambda spark, d: clean.value_to_null(T(spark, d).raw_fish.select("key_aa", "ray_ct"), {"ray_ct": "N"}))

register("cln_conditional_null", W("raw_fish") + f"""
SELECT key_aa, species, CASE WHEN species IN ({_NATIVE}) THEN tubercles END AS tubercles FROM raw_fish""")(
    lambda spark, d: clean.keep_if_in(T(spark, d).raw_fish.select("key_aa", "species", "tubercles"),
                                      "tubercles", "species", NATIVE))

register("cln_null_default", W("fish", "pittag") + "SELECT pit_id, coalesce(pit_recap, 'N') AS pit_recap FROM pittag")(
    lambda spark, d: clean.null_default(T(spark, d).pittag.select("pit_id", "pit_recap"), {"pit_recap": "N"}))

register("cln_case", W("raw_site") + "SELECT key_a, lower(project) AS project, upper(crew) AS crew FROM raw_site")(
    lambda spark, d: clean.change_case(T(spark, d).raw_site.select("key_a", "project", "crew"),
                                       upper=["crew"], lower=["project"]))

register("flt_not_null", W("raw_fish", "raw_pittag") + """
SELECT key_aaa, nullif(pit_num, 'Z') AS pit_num, nullif(pit_recap, 'Z') AS pit_recap FROM raw_pittag WHERE pit_num IS NOT NULL""")(
    lambda spark, d: clean.sentinel_to_null(
        T(spark, d).raw_pittag.filter(F.col("pit_num").isNotNull()).select("key_aaa", "pit_num", "pit_recap")))

register("flt_predicates", W("fish") + """
SELECT * FROM fish WHERE species IN ('SM', 'CS') AND year(datetime) = 1998""")(
    lambda spark, d: T(spark, d).fish.filter(F.col("species").isin("SM", "CS") & (F.year("datetime") == 1998)))

# ------------------------------------------------------------------ projections
register("prj_select_rename", W("site") + """
SELECT site_id, river AS rvr_code, reach AS rch_code, pass FROM site""")(
    lambda spark, d: T(spark, d).site.select("site_id", F.col("river").alias("rvr_code"),
                                             F.col("reach").alias("rch_code"), "pass"))

register("prj_column_range", W("site") + "SELECT site_id, key_a, project_code, year, river, reach FROM site")(
    lambda spark, d: T(spark, d).site.select(*prj.column_range(T(spark, d).site, "site_id", "reach")))

register("prj_move_first", W("fish") + """
SELECT species, rmi, fish_id, site_id, key_a, datetime, tot_length, weight, sex, rep_cond, tubercles, ray_ct, disp, loc_x, loc_y,
  epsg, fish_notes, ilon, ilat FROM fish""")(
    lambda spark, d: prj.move_first(T(spark, d).fish, "species", "rmi"))

register("prj_drop_matching", W("site") + SITE_QC_SQL + """
SELECT site_id, project_code, year, river, reach, pass, startdatetime, enddatetime, start_rmi, end_rmi, el_sec, crew FROM q""")(
    lambda spark, d: prj.drop_matching(qc.site_qc(site_input(T(spark, d))), r"_flg$|_index$|^key_"))

register("prj_mutate_suffix", W("site") + """
SELECT site_id, reach, CASE WHEN reach IN ('DESO', 'ECHO') THEN start_rmi + 120 ELSE start_rmi END AS start_rmi,
  CASE WHEN reach IN ('DESO', 'ECHO') THEN end_rmi + 120 ELSE end_rmi END AS end_rmi FROM site""")(
    lambda spark, d: prj.mutate_where(T(spark, d).site.select("site_id", "reach", "start_rmi", "end_rmi"),
                                      prj.ends_with("rmi"), lambda c: clean.mile_correction(c, F.col("reach"))))

# ------------------------------------------------------------------ scalar functions
register("fn_datetime_parse", W("raw_site") + RAW_SITE_CLEAN + f"""
SELECT key_a, try_strptime(date || ' ' || starttime, {_TS}) AS startdatetime,
  try_strptime(date || ' ' || endtime, {_TS}) AS enddatetime FROM rs""")(
    lambda spark, d: clean.sentinel_to_null(T(spark, d).raw_site).select(
        "key_a", clean.mdy_time(F.col("date"), F.col("starttime")).alias("startdatetime"),
        clean.mdy_time(F.col("date"), F.col("endtime")).alias("enddatetime")))

register("fn_mile_correction", W("fish", "site") + """
SELECT f.fish_id, s.reach, CASE WHEN s.reach IN ('DESO', 'ECHO') THEN f.rmi + 120 ELSE f.rmi END AS rmi
FROM fish f LEFT JOIN site s ON f.site_id = s.site_id""")(
    lambda spark, d: T(spark, d).fish.join(T(spark, d).site.select("site_id", "reach"), "site_id", "left").select(
        "fish_id", "reach", clean.mile_correction(F.col("rmi"), F.col("reach")).alias("rmi")))

register("fn_mid_mile", W("site") + """
SELECT site_id, start_rmi, end_rmi, round_even(start_rmi + end_rmi, 0) / 2 AS mid_rmi,
  round_even((start_rmi + end_rmi) / 2, 1) AS mid_rmi_intended FROM site""")(
    lambda spark, d: T(spark, d).site.select(
        "site_id", "start_rmi", "end_rmi",
        (r_round(F.col("start_rmi") + F.col("end_rmi"), 0) / 2).alias("mid_rmi"),
        r_round((F.col("start_rmi") + F.col("end_rmi")) / 2, 1).alias("mid_rmi_intended")))

register("fn_ripe", W("fish") + """
SELECT fish_id, rep_cond, CASE WHEN regexp_matches(rep_cond, '^INT+') THEN 'N' WHEN regexp_matches(rep_cond, '^EXP+') THEN 'Y' END AS ripe
FROM fish""")(lambda spark, d: T(spark, d).fish.select("fish_id", "rep_cond", products.ripe().alias("ripe")))

register("fn_sub_first", "SELECT c_custkey, c_name, regexp_replace(c_name, '[a-z]+', '') AS agency FROM customer")(
    lambda spark, d: T(spark, d).customer.select("c_custkey", "c_name", sub_first(F.col("c_name"), "[a-z]+").alias("agency")))

register("fn_separate", W("fish") + """
SELECT fish_id, split_part(fish_id, '-', 1) AS order_part, split_part(fish_id, '-', 2) AS line_part FROM fish""")(
    lambda spark, d: T(spark, d).fish.select(
        "fish_id", F.try_element_at(F.split("fish_id", "-"), F.lit(1)).alias("order_part"),
        F.try_element_at(F.split("fish_id", "-"), F.lit(2)).alias("line_part")))

# ------------------------------------------------------------------ family scans
def _families(t):
    return {
        "123a+site": t.raw_site.filter(F.col("key_a") % 2 == 0),
        "123b+site": t.raw_site.filter(F.col("key_a") % 2 == 1).withColumn("gps_unit", F.lit("G1")),
        "123a+fish": t.raw_fish,
        "123a+water": t.raw_water,
    }


register("src_family_union", W("raw_site") + """
SELECT *, CAST(NULL AS VARCHAR) AS gps_unit FROM raw_site WHERE key_a % 2 = 0
UNION ALL SELECT *, 'G1' AS gps_unit FROM raw_site WHERE key_a % 2 = 1""")(
    lambda spark, d: union_family(_families(T(spark, d)), "site"))

register("src_lower_columns", W("raw_site") + "SELECT * FROM raw_site")(
    lambda spark, d: prj.lower_columns(T(spark, d).raw_site.toDF(*[c.upper() for c in T(spark, d).raw_site.columns])))
