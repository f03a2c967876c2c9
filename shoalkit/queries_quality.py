"""Queries: quality rules and the flag/NULL predicates they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import T, W, register
from .fixtures import REACH_BOUNDS_ROWS
from .functions.nulls import any_null
from .operators import quality as qc

_D = "CAST({} AS DOUBLE)"


def _in_reach_sql(*miles):
    parts = []
    for code, lo, hi in REACH_BOUNDS_ROWS:
        conds = " AND ".join(f"{m} BETWEEN {_D.format(lo)} AND {_D.format(hi)}" for m in miles)
        parts.append(f"(reach = '{code}' AND {conds})")
    return " OR ".join(parts)


def _n1(cond):
    return f"CASE WHEN ({cond}) THEN 'FLAG' WHEN NOT ({cond}) THEN '' END"


# ------------------------------------------------------------ site rules
def site_input(t):
    s = t.site
    return s.select(F.col("key_a").alias("s_index"), "site_id", "project_code", "year", "river", "reach",
                    "pass", "startdatetime",
                    F.timestamp_add("SECOND", F.col("elapsed_sec"), F.col("startdatetime")).alias("enddatetime"),
                    "start_rmi", "end_rmi", "el_sec", "crew", "key_a")


SITE_INPUT_SQL = """
, s AS (SELECT key_a AS s_index, site_id, project_code, year, river, reach, pass, startdatetime,
    startdatetime + to_seconds(elapsed_sec) AS enddatetime, start_rmi, end_rmi, el_sec, crew, key_a FROM site)"""

_SITE_NA = ("s_index IS NULL OR site_id IS NULL OR project_code IS NULL OR year IS NULL OR river IS NULL "
            "OR reach IS NULL OR pass IS NULL OR startdatetime IS NULL OR enddatetime IS NULL "
            "OR start_rmi IS NULL OR end_rmi IS NULL OR el_sec IS NULL OR crew IS NULL")
_SITE_COMMON = f"""
  {_n1("date_diff('second', startdatetime, enddatetime) < el_sec")} AS datetime_flg,
  {_n1("el_sec > 7200 OR el_sec < 1000")} AS el_sec_flg,
  CASE WHEN {_SITE_NA} THEN 'FLAG' ELSE '' END AS NA_flg"""
SITE_QC_SQL = SITE_INPUT_SQL + f"""
, q AS (SELECT *,
  {_n1("start_rmi - end_rmi > 5 OR start_rmi < end_rmi")} AS rmi_length_flg,
  CASE WHEN {_in_reach_sql("start_rmi", "end_rmi")} THEN '' ELSE 'FLAG' END AS rmi_flg,{_SITE_COMMON}
FROM s)
"""

register("qc_site", W("site") + SITE_QC_SQL + "SELECT * FROM q")(
    lambda spark, d: qc.site_qc(site_input(T(spark, d))))

register("flt_any_flag", W("site") + SITE_QC_SQL + """
SELECT * FROM q WHERE rmi_length_flg = 'FLAG' OR rmi_flg = 'FLAG' OR datetime_flg = 'FLAG'
  OR el_sec_flg = 'FLAG' OR NA_flg = 'FLAG'""")(
    lambda spark, d: qc.flagged_only(qc.site_qc(site_input(T(spark, d)))))

# ------------------------------------------------------------ fish rules
def _fish_inputs(t):
    """Site keys, and the fish (some without site) with the reach of their site."""
    sf = t.site
    site = sf.select(F.col("key_a").alias("s_index"), "site_id", "key_a")
    fish = (t.fish.join(sf.select("site_id", "reach"), "site_id", "left")
            .select("fish_id", "site_id", "key_a", "reach", "rmi", "species", "tot_length", "weight", "disp"))
    return site, fish


def _q_fish(spark, d):
    site, fish = _fish_inputs(T(spark, d))
    return qc.fish_qc(fish, site)


_NATIVE = ", ".join(f"'{s}'" for s in qc.NATIVE)
_COMMON = ", ".join(f"'{s}'" for s in qc.COMMON_SPECIES)
_NOT_LARGE = "(species IS NULL OR species NOT IN ('CC', 'GC', 'NP'))"
FISH_QC_SQL = f"""
, sf AS (SELECT key_a AS s_index, site_id, key_a, reach FROM site)
, f AS (SELECT f.fish_id, f.site_id, f.key_a, sf.reach, f.rmi, f.species, f.tot_length, f.weight, f.disp
        FROM fish f LEFT JOIN sf ON f.site_id = sf.site_id)
, j AS (SELECT p.s_index, coalesce(p.site_id, f.site_id) AS site_id, coalesce(p.key_a, f.key_a) AS key_a,
          f.fish_id, f.reach, f.rmi, f.species, f.tot_length, f.weight, f.disp
        FROM sf p FULL JOIN f ON p.site_id IS NOT DISTINCT FROM f.site_id AND p.key_a IS NOT DISTINCT FROM f.key_a)
, qf AS (SELECT *,
  CASE WHEN s_index IS NULL THEN 'FLAG' ELSE '' END AS orphan_flg,
  CASE WHEN fish_id IS NULL THEN 'FLAG' ELSE '' END AS zero_catch_flg,
  CASE WHEN {_in_reach_sql("rmi")} THEN '' ELSE 'FLAG' END AS rmi_flg,
  CASE WHEN species IS NULL OR species NOT IN ({_COMMON}) THEN 'FLAG' ELSE '' END AS species_flg,
  {_n1(_NOT_LARGE + " AND tot_length > 1000")} AS tot_length_flg,
  {_n1(_NOT_LARGE + " AND weight > 2800")} AS weight_flg,
  {_n1(f"(disp = 'DE' AND coalesce(species IN ({_NATIVE}), false)) OR (disp = 'RA' AND NOT coalesce(species IN ({_NATIVE}), false)) OR disp IS NULL")} AS disp_flg
FROM j)
"""
register("qc_fish", W("site", "fish") + FISH_QC_SQL + "SELECT * FROM qf")(_q_fish)


# ------------------------------------------------------------ pit rules
def _q_pit(spark, d):
    t = T(spark, d)
    fish = t.fish.select(F.col("key_a").alias("f_index"), "fish_id", "species")
    pit = t.pittag.select("pit_id", "fish_id", "site_id", "species", "pit_type", "pit_num", "pit_recap")
    return qc.pit_qc(pit, fish)


PIT_QC_SQL = f"""
, p AS (SELECT key_a AS f_index, fish_id, species FROM fish)
, pj AS (SELECT p.f_index, coalesce(p.fish_id, t.fish_id) AS fish_id, coalesce(p.species, t.species) AS species,
          t.pit_id, t.site_id, t.pit_type, t.pit_num, t.pit_recap
        FROM p RIGHT JOIN pittag t ON p.fish_id IS NOT DISTINCT FROM t.fish_id AND p.species IS NOT DISTINCT FROM t.species)
, qp AS (SELECT *,
  CASE WHEN f_index IS NULL THEN 'FLAG' ELSE '' END AS orphan_flg,
  {_n1("pit_recap = 'NNF'")} AS nnf_flg,
  CASE WHEN (pit_recap IS NULL AND pit_num IS NOT NULL) OR (pit_num IS NULL AND pit_recap IS NOT NULL) THEN 'FLAG' ELSE '' END AS pit_recap_flg,
  CASE WHEN pit_type = '134' AND length(pit_num) <> 14 THEN 'FLAG' WHEN pit_type = '400' AND length(pit_num) <> 9 THEN 'FLAG' END AS invalid_pitnum_flg
FROM pj)
"""
register("qc_pit", W("fish", "pittag") + PIT_QC_SQL + "SELECT * FROM qp")(_q_pit)


# ------------------------------------------------------------ floy rules
register("qc_floy", W("floytag") + """
SELECT *, CASE WHEN floy_id IS NULL OR fish_id IS NULL OR site_id IS NULL OR species IS NULL OR floy_color IS NULL
  OR floy_num IS NULL OR floy_recap IS NULL THEN 'FLAG' ELSE '' END AS NA_flg FROM floytag""")(
    lambda spark, d: qc.floy_qc(T(spark, d).floytag, "floy_id", "floy_recap"))


# ------------------------------------------------------------ any NULL across a range
register("fn_any_null", W("fish") + """
SELECT fish_id, (species IS NULL OR tot_length IS NULL OR weight IS NULL OR sex IS NULL OR rep_cond IS NULL
  OR disp IS NULL) AS any_na FROM fish""")(
    lambda spark, d: T(spark, d).fish.select(
        "fish_id", any_null(["species", "tot_length", "weight", "sex", "rep_cond", "disp"]).alias("any_na")))


# ------------------------------------------------------------ v1 rule set, flagged rows only
def _q_v1(spark, d):
    t = T(spark, d)
    site_keys, fish = _fish_inputs(t)
    fish_keys = t.fish.select(F.col("key_a").alias("f_index"), "fish_id", "species")
    pit = t.pittag.select("pit_id", "fish_id", "site_id", "species", "pit_type", "pit_num", "pit_recap")
    parts = [qc.site_qc(site_input(t), version=1).withColumn("tbl", F.lit("site")),
             qc.fish_qc(fish, site_keys, version=1).withColumn("tbl", F.lit("fish")),
             qc.pit_qc(pit, fish_keys, version=1).withColumn("tbl", F.lit("pittag"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


_V1_FISH_FLAGS = f"""
  CASE WHEN s_index IS NULL THEN 'FLAG' ELSE '' END AS orphan_flg,
  CASE WHEN fish_id IS NULL THEN 'FLAG' ELSE '' END AS zero_catch_flg,
  CASE WHEN species IS NULL OR species NOT IN ({_COMMON}) THEN 'FLAG' ELSE '' END AS species_flg,
  {_n1(_NOT_LARGE + " AND tot_length > 1000")} AS tot_length_flg,
  {_n1(_NOT_LARGE + " AND weight > 2800")} AS weight_flg,
  {_n1(f"(disp = 'DE' AND coalesce(species IN ({_NATIVE}), false)) OR (disp = 'RA' AND NOT coalesce(species IN ({_NATIVE}), false))")} AS disp_flg"""

register("qc_v1_flagged_only", W("site", "fish", "pittag") + SITE_INPUT_SQL + f"""
, qs AS (SELECT *, {_n1("start_rmi - end_rmi > 5")} AS rmi_flg,{_SITE_COMMON}, 'site' AS tbl FROM s)
, sf AS (SELECT key_a AS s_index, site_id, key_a, reach FROM site)
, f AS (SELECT f.fish_id, f.site_id, f.key_a, sf.reach, f.rmi, f.species, f.tot_length, f.weight, f.disp
        FROM fish f LEFT JOIN sf ON f.site_id = sf.site_id)
, j AS (SELECT p.s_index, coalesce(p.site_id, f.site_id) AS site_id, coalesce(p.key_a, f.key_a) AS key_a,
          f.fish_id, f.reach, f.rmi, f.species, f.tot_length, f.weight, f.disp
        FROM sf p FULL JOIN f ON p.site_id IS NOT DISTINCT FROM f.site_id AND p.key_a IS NOT DISTINCT FROM f.key_a)
, qf AS (SELECT *,{_V1_FISH_FLAGS}, 'fish' AS tbl FROM j)
, p AS (SELECT key_a AS f_index, fish_id, species FROM fish)
, pj AS (SELECT p.f_index, coalesce(p.fish_id, t.fish_id) AS fish_id, coalesce(p.species, t.species) AS species,
          t.pit_id, t.site_id, t.pit_type, t.pit_num, t.pit_recap
        FROM p FULL JOIN pittag t ON p.fish_id IS NOT DISTINCT FROM t.fish_id AND p.species IS NOT DISTINCT FROM t.species)
, qp AS (SELECT *,
  CASE WHEN f_index IS NULL THEN 'FLAG' ELSE '' END AS orphan_flg,
  {_n1("pit_recap = 'NNF'")} AS nnf_flg,
  CASE WHEN (pit_recap IS NULL AND pit_num IS NOT NULL) OR (pit_num IS NULL AND pit_recap IS NOT NULL) THEN 'FLAG' ELSE '' END AS pit_recap_flg,
  CASE WHEN pit_type = '134' AND length(pit_num) <> 14 THEN 'FLAG' WHEN pit_type = '400' AND length(pit_num) <> 9 THEN 'FLAG' END AS invalid_pitnum_flg,
  'pittag' AS tbl FROM pj)
SELECT * FROM qs WHERE rmi_flg = 'FLAG' OR datetime_flg = 'FLAG' OR el_sec_flg = 'FLAG' OR NA_flg = 'FLAG'
UNION ALL BY NAME SELECT * FROM qf WHERE 'FLAG' IN (orphan_flg, zero_catch_flg, species_flg, tot_length_flg, weight_flg, disp_flg)
UNION ALL BY NAME SELECT * FROM qp WHERE 'FLAG' IN (orphan_flg, nnf_flg, pit_recap_flg, invalid_pitnum_flg)""")(_q_v1)
