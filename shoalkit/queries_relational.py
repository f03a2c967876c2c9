"""Queries: joins, aggregates, windows, sort and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import T, W, YEARS, register
from .functions.nulls import asc_last
from .operators import aggregate as agg
from .operators import joins as jn
from .operators import keys
from .plans import effort

_Y = ", ".join(str(y) for y in YEARS)

# ================================================================ joins
register("jn_left_lookup", W("site", "tbl_reach") + """
SELECT s.site_id, s.reach, r.rch_name, r.rvr_code FROM site s LEFT JOIN tbl_reach r ON s.reach = r.rch_code""")(
    lambda spark, d: jn.lookup(T(spark, d).site.select("site_id", "reach"), T(spark, d).tbl_reach,
                               {"reach": "rch_code"}))

register("jn_left_parent", W("site", "fish") + """
SELECT f.fish_id, f.site_id, s.startdatetime AS t_stamp, s.reach
FROM fish f LEFT JOIN site s ON f.site_id = s.site_id""")(
    lambda spark, d: T(spark, d).fish.select("fish_id", "site_id").join(
        T(spark, d).site.select("site_id", F.col("startdatetime").alias("t_stamp"), "reach"), "site_id", "left"))

register("jn_left_multi", W("site", "meta") + """
SELECT s.site_id, s.project_code, s.year, m.principal_lname, m.agency
FROM site s LEFT JOIN meta m ON s.project_code = m.project_code AND s.year = m.year""")(
    lambda spark, d: T(spark, d).site.select("site_id", "project_code", "year").join(
        T(spark, d).meta.select("project_code", "year", "principal_lname", "agency"), ["project_code", "year"], "left"))

register("jn_inner", W("site", "fish") + """
SELECT f.fish_id, f.site_id, s.year, s.pass FROM fish f JOIN site s ON f.site_id = s.site_id WHERE s.year IN (""" + _Y + ")")(
    lambda spark, d: T(spark, d).fish.select("fish_id", "site_id").join(
        T(spark, d).site.filter(F.col("year").isin(list(YEARS))).select("site_id", "year", "pass"), "site_id", "inner"))


def _daily_param(t, code, name):
    return (t.daily.filter(F.col("code") == code).groupBy("staid", "date")
            .agg(F.avg("val").alias(name)))


_DAILY_SQL = """
, dis AS (SELECT staid, date, avg(val) AS discharge FROM daily WHERE code = '00060' GROUP BY staid, date)
, tmp AS (SELECT staid, date, avg(val) AS temp FROM daily WHERE code = '00010' GROUP BY staid, date)"""

register("jn_full_outer", W("daily") + _DAILY_SQL + """
SELECT coalesce(dis.staid, tmp.staid) AS staid, coalesce(dis.date, tmp.date) AS date, discharge, temp
FROM dis FULL JOIN tmp ON dis.staid = tmp.staid AND dis.date = tmp.date""")(
    lambda spark, d: jn.full_join(_daily_param(T(spark, d), "00060", "discharge"),
                                  _daily_param(T(spark, d), "00010", "temp"), ["staid", "date"]))

register("jn_natural_full", W("site", "fish") + """
, a AS (SELECT site_id, key_a, reach FROM site)
SELECT coalesce(a.site_id, f.site_id) AS site_id, coalesce(a.key_a, f.key_a) AS key_a, a.reach, f.fish_id
FROM a FULL JOIN (SELECT fish_id, site_id, key_a FROM fish) f
  ON a.site_id IS NOT DISTINCT FROM f.site_id AND a.key_a IS NOT DISTINCT FROM f.key_a""")(
    lambda spark, d: jn.natural_join(
        T(spark, d).site.select("site_id", "key_a", "reach"),
        T(spark, d).fish.select("fish_id", "site_id", "key_a"), "full", null_safe=True))

register("jn_natural_right", W("fish", "pittag") + """
SELECT coalesce(f.fish_id, p.fish_id) AS fish_id, coalesce(f.species, p.species) AS species, f.key_a, p.pit_id
FROM (SELECT fish_id, species, key_a FROM fish) f
RIGHT JOIN pittag p ON f.fish_id IS NOT DISTINCT FROM p.fish_id AND f.species IS NOT DISTINCT FROM p.species""")(
    lambda spark, d: jn.natural_join(
        T(spark, d).fish.select("fish_id", "species", "key_a"),
        T(spark, d).pittag.select("pit_id", "fish_id", "species"), "right", null_safe=True))

register("jn_semi", W("site", "fish") + """
SELECT * FROM fish f WHERE EXISTS (SELECT 1 FROM site s WHERE s.site_id = f.site_id AND s.year IN (""" + _Y + "))")(
    lambda spark, d: T(spark, d).fish.join(
        T(spark, d).site.filter(F.col("year").isin(list(YEARS))).select("site_id"), "site_id", "left_semi"))

register("jn_anti", W("fish", "pittag") + """
SELECT * FROM fish f WHERE NOT EXISTS (SELECT 1 FROM pittag p WHERE p.fish_id = f.fish_id AND p.pit_num IS NOT NULL)""")(
    lambda spark, d: T(spark, d).fish.join(
        T(spark, d).pittag.filter(F.col("pit_num").isNotNull()).select("fish_id"), "fish_id", "left_anti"))


def _q_null_safe(spark, d):
    f = T(spark, d).fish.select("fish_id", "site_id", "species")
    counts = agg.count_by(f, ["site_id", "species"], "n_same")
    return jn.null_safe_join(f, counts, ["site_id", "species"], "inner")


register("jn_null_safe", W("fish") + """
, c AS (SELECT site_id, species, count(*) AS n_same FROM fish GROUP BY site_id, species)
SELECT f.fish_id, f.site_id, f.species, c.n_same FROM fish f
JOIN c ON f.site_id IS NOT DISTINCT FROM c.site_id AND f.species IS NOT DISTINCT FROM c.species""")(_q_null_safe)

register("jn_broadcast", W("fish", "tbl_spp") + """
SELECT f.fish_id, f.species, s.com_name, s.sci_name FROM fish f JOIN tbl_spp s ON f.species = s.spp_code""")(
    lambda spark, d: T(spark, d).fish.select("fish_id", "species").join(
        T(spark, d).tbl_spp.select(F.col("spp_code").alias("species"), "com_name", "sci_name"),
        "species"))


def _q_cross(spark, d):
    t = T(spark, d)
    left = t.site.select("pass", "reach").distinct()
    return agg.expand_grid(left, t.fish, ["species"])


register("jn_cross_complete", W("site", "fish") + """
SELECT l.pass, l.reach, r.species FROM (SELECT DISTINCT pass, reach FROM site) l
CROSS JOIN (SELECT DISTINCT species FROM fish) r""")(_q_cross)


def _reach_input(t):
    return jn.lookup(t.site.select("site_id", "reach", "start_rmi", "end_rmi"),
                     t.tbl_reach.select("rch_code", "rvr_code"), {"reach": "rch_code"}) \
        .withColumn("mid_rmi", (F.col("start_rmi") + F.col("end_rmi")) / 2)


def _q_range_reach(spark, d):
    t = T(spark, d)
    bounds = t.reach_bounds.join(t.tbl_reach.select("rch_code", "rvr_code"), "rch_code")
    return jn.assign_reach(_reach_input(t).drop("reach"), bounds, "rvr_code", "mid_rmi", "reach")


register("jn_range_reach", W("site", "tbl_reach", "reach_bounds") + """
, i AS (SELECT s.site_id, s.start_rmi, s.end_rmi, r.rvr_code, (s.start_rmi + s.end_rmi) / 2 AS mid_rmi
        FROM site s LEFT JOIN tbl_reach r ON s.reach = r.rch_code)
, b AS (SELECT b.rch_code, r.rvr_code, b.min_rmi, b.max_rmi FROM reach_bounds b JOIN tbl_reach r ON b.rch_code = r.rch_code)
SELECT i.site_id, i.start_rmi, i.end_rmi, i.rvr_code, i.mid_rmi, b.rch_code AS reach
FROM i LEFT JOIN b ON i.rvr_code = b.rvr_code AND i.mid_rmi >= b.min_rmi AND i.mid_rmi < b.max_rmi""")(_q_range_reach)

register("jn_range_life_stage", W("fish", "stage_bounds") + """
SELECT f.fish_id, f.species, f.tot_length, b.life_stage
FROM (SELECT fish_id, species, tot_length FROM fish WHERE species IN ('SM', 'CS')) f
LEFT JOIN stage_bounds b ON f.species = b.species AND f.tot_length >= b.min_len AND f.tot_length < b.max_len""")(
    lambda spark, d: jn.life_stage(
        T(spark, d).fish.filter(F.col("species").isin("SM", "CS")).select("fish_id", "species", "tot_length"),
        T(spark, d).stage_bounds))

# ================================================================ aggregates
register("agg_mean_point", W("fish") + """
SELECT site_id, rmi, avg(ilon) AS ilon, avg(ilat) AS ilat FROM fish GROUP BY site_id, rmi HAVING avg(ilon) IS NOT NULL""")(
    lambda spark, d: agg.mean_point(T(spark, d).fish, ["site_id", "rmi"], "ilon", "ilat"))

register("agg_length_stats", W("site", "fish") + """
SELECT s.reach, round_even(avg(f.tot_length), 2) AS mean_tl, min(f.tot_length) AS min_tl, max(f.tot_length) AS max_tl,
  stddev_samp(f.tot_length) AS sd_tl
FROM fish f LEFT JOIN site s ON f.site_id = s.site_id WHERE f.species = 'SM' GROUP BY s.reach""")(
    lambda spark, d: agg.length_stats(
        T(spark, d).fish.filter(F.col("species") == "SM").join(T(spark, d).site.select("site_id", "reach"), "site_id", "left"),
        ["reach"], "tot_length", prefix="tl"))

_EFFORT_SQL = """
, f AS (SELECT site_id, count(*) AS ct FROM fish WHERE species IN ('SM') GROUP BY site_id)
SELECT {keys}, count(*) AS n_site,
  round_even(CASE WHEN count(s.el_sec) = count(*) THEN sum(s.el_sec) END / 3600, 2) AS effort_hr,
  CAST(coalesce(sum(f.ct), 0) AS BIGINT) AS {catch},
  round_even(CASE WHEN round_even(CASE WHEN count(s.el_sec) = count(*) THEN sum(s.el_sec) END / 3600, 2) = 0 THEN NULL
        ELSE coalesce(sum(f.ct), 0) / round_even(CASE WHEN count(s.el_sec) = count(*) THEN sum(s.el_sec) END / 3600, 2) END, 2) AS cpue{extra}
FROM {site} s LEFT JOIN f ON s.site_id = f.site_id GROUP BY {keys}"""

register("agg_effort_stats", W("site", "fish") + _EFFORT_SQL.format(
    keys="s.pass", catch="catch", extra=", 'SM' AS species", site="site"))(
    lambda spark, d: effort.effort_stats(T(spark, d).site, T(spark, d).fish, ["SM"], ["pass"]))


def _q_effort_reach(spark, d):
    t = T(spark, d)
    site = t.site.filter(F.col("year").isin(list(YEARS)))
    fish = t.fish.join(site.select("site_id"), "site_id", "inner")
    return effort.effort_stats(site, fish, ["SM"], ["reach", "pass"], catch_name="SM", species_col=None)


register("agg_effort_stats_reach", W("site", "fish") + _EFFORT_SQL.format(
    keys="s.reach, s.pass", catch="SM", extra="", site=f"(SELECT * FROM site WHERE year IN ({_Y}))"))(_q_effort_reach)


def year_tables(t):
    site = t.site.filter(F.col("year").isin(list(YEARS)))
    fish = t.fish.join(site.select("site_id"), "site_id", "left_semi")
    return site, fish


_ROLLUP_SQL = """
, sy AS (SELECT * FROM site WHERE year IN (""" + _Y + """))
, fy AS (SELECT * FROM fish f WHERE EXISTS (SELECT 1 FROM sy WHERE sy.site_id = f.site_id))
, c AS (SELECT f.site_id, f.species, s.reach, s.pass, s.el_sec, count(*) AS fish_count
        FROM fy f LEFT JOIN sy s ON f.site_id = s.site_id GROUP BY f.site_id, f.species, s.reach, s.pass, s.el_sec)
, l AS (SELECT DISTINCT site_id, reach, pass, el_sec FROM c)
, r AS (SELECT DISTINCT species FROM c)
, g AS (SELECT l.site_id, l.reach, l.pass, l.el_sec, r.species, coalesce(c.fish_count, 0) AS fish_count
        FROM l CROSS JOIN r LEFT JOIN c ON c.site_id = l.site_id AND c.reach IS NOT DISTINCT FROM l.reach
          AND c.pass IS NOT DISTINCT FROM l.pass AND c.el_sec IS NOT DISTINCT FROM l.el_sec
          AND c.species IS NOT DISTINCT FROM r.species)
, fc AS (SELECT pass, reach, species,
          round_even(CASE WHEN count(el_sec) = count(*) THEN sum(el_sec) END / 3600, 2) AS effort,
          CAST(sum(fish_count) AS BIGINT) AS catch FROM g GROUP BY pass, reach, species)"""

register("agg_rollup_two_level", W("site", "fish") + _ROLLUP_SQL + """
SELECT pass, reach, species, effort, catch,
  round_even(CASE WHEN effort = 0 THEN NULL ELSE catch / effort END, 2) AS cpue FROM fc""")(
    lambda spark, d: effort.cpue_by(*year_tables(T(spark, d))))

register("agg_rollup_reach", W("site", "fish") + _ROLLUP_SQL + """
SELECT reach, coalesce(sum(effort), 0) AS effort, CAST(coalesce(sum(catch), 0) AS BIGINT) AS catch,
  round_even(CASE WHEN coalesce(sum(effort), 0) = 0 THEN NULL ELSE coalesce(sum(catch), 0) / coalesce(sum(effort), 0) END, 2) AS cpue
FROM fc WHERE species = 'SM' GROUP BY reach""")(
    lambda spark, d: effort.cpue_rollup(effort.cpue_by(*year_tables(T(spark, d))), "SM"))


def _q_max_id(spark, d):
    return T(spark, d).site.agg(agg.next_number_col("upload_id").alias("next_upload_id"),
                                agg.next_number_col("site_id", r"(\d+)$").alias("next_site_num"))


register("agg_max_id", W("site") + """
SELECT CAST(coalesce(max(upload_id), 0) + 1 AS BIGINT) AS next_upload_id,
  coalesce(max(CAST(regexp_extract(site_id, '(\\d+)$', 1) AS BIGINT)), 0) + 1 AS next_site_num FROM site""")(_q_max_id)

register("agg_distinct_nesting", W("site") + "SELECT DISTINCT reach, pass FROM site")(
    lambda spark, d: agg.distinct_nesting(T(spark, d).site, ["reach", "pass"]))

# ================================================================ windows, sort, sets
register("win_row_index", W("site") + """
SELECT site_id, key_a, startdatetime, row_number() OVER (ORDER BY startdatetime ASC NULLS LAST, key_a) AS s_index FROM site""")(
    lambda spark, d: keys.global_index(T(spark, d).site.select("site_id", "key_a", "startdatetime"),
                                       ["startdatetime", "key_a"], "s_index"))


def _q_site_id(spark, d):
    s = T(spark, d).site.select("key_a", "project_code", "startdatetime")
    idx = keys.global_index(s, ["startdatetime", "key_a"], "s_index")
    start_num = 5
    return idx.select("key_a", "s_index",
                      keys.build_key([F.col("project_code"), F.year("startdatetime")],
                                     F.col("s_index") + (start_num - 1)).alias("new_site_id"))


register("win_site_id", W("site") + """
SELECT key_a, s_index, project_code || '_' || CAST(year(startdatetime) AS VARCHAR) || '_' ||
  CASE WHEN s_index + 4 < 1000 THEN lpad(CAST(s_index + 4 AS VARCHAR), 3, '0') ELSE CAST(s_index + 4 AS VARCHAR) END AS new_site_id
FROM (SELECT key_a, project_code, startdatetime,
        row_number() OVER (ORDER BY startdatetime ASC NULLS LAST, key_a) AS s_index FROM site) t""")(_q_site_id)

register("srt_nulls_last", W("fish") + """
SELECT fish_id, datetime, species FROM fish ORDER BY species ASC NULLS LAST, fish_id""")(
    lambda spark, d: T(spark, d).fish.select("fish_id", "datetime", "species").orderBy(asc_last("species"), "fish_id"))

register("set_union_by_name", W("pittag", "floytag") + """
SELECT pit_id, fish_id, site_id, species, pit_type, pit_num, pit_recap, pit_notes,
  CAST(NULL AS VARCHAR) AS floy_id, CAST(NULL AS VARCHAR) AS floy_color, CAST(NULL AS VARCHAR) AS floy_num,
  CAST(NULL AS VARCHAR) AS floy_recap, CAST(NULL AS INTEGER) AS floy_ref, CAST(NULL AS VARCHAR) AS floy_notes FROM pittag
UNION ALL
SELECT NULL, fish_id, site_id, species, NULL, NULL, NULL, NULL, floy_id, floy_color, floy_num, floy_recap, floy_ref, floy_notes FROM floytag""")(
    lambda spark, d: T(spark, d).pittag.unionByName(T(spark, d).floytag, allowMissingColumns=True))
