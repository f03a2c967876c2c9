"""Queries: products from the normalised warehouse."""

from __future__ import annotations

from .catalog import AS_OF_SQL, T, W, register
from .plans import warehouse as wh

YEAR, PROJECT = 1998, "123d"
_WH = ("study_event", "study", "gear", "org", "hydro", "person", "species", "individual", "encounter", "tag",
       "tag_type", "disposition", "sex", "ntf")


def wh_tables(t):
    return {n: t[f"wh_{n}"] for n in _WH}


def _site_p(t):
    return wh.site_pointer(wh_tables(t), YEAR, PROJECT)


_SP_SQL = f"""
, ev AS (SELECT * FROM wh_study_event WHERE year(StartDateTime) = {YEAR})
, sp AS (SELECT ev.*, st.Code AS StudyCode, st.Name AS StudyName, g.Code AS GearCode, o.Name AS OrgName,
    h.Code AS rvr_code, h.Name AS rvr_name, h.BasinID, p.FirstName, p.LastName
  FROM ev LEFT JOIN wh_study st ON ev.StudyID = st.ID LEFT JOIN wh_gear g ON ev.GearTypeID = g.ID
  LEFT JOIN wh_org o ON ev.OrgID = o.ID LEFT JOIN wh_hydro h ON ev.RiverID = h.ID
  LEFT JOIN wh_person p ON ev.PersonID = p.ID WHERE st.Code = '{PROJECT}')"""
_SP_TABLES = ("wh_study_event", "wh_study", "wh_gear", "wh_org", "wh_hydro", "wh_person")


def _q_site(spark, d):
    t = T(spark, d)
    bounds = t.reach_bounds.join(t.tbl_reach.select("rch_code", "rvr_code"), "rch_code")
    return wh.wh_site(wh_tables(t), YEAR, PROJECT, bounds, t.tbl_reach)


register("dp_wh_site", W(*_SP_TABLES, "reach_bounds", "tbl_reach") + _SP_SQL + f"""
, s2 AS (SELECT sp.*, round_even(StartRMI + EndRMI, 0) / 2 AS mid_rmi,
    coalesce(LastName, 'NA') || ', ' || coalesce(FirstName, 'NA') AS principal,
    regexp_replace(OrgName, '[a-z]+', '') AS agency FROM sp)
, b AS (SELECT b.rch_code, r.rvr_code, b.min_rmi, b.max_rmi FROM reach_bounds b JOIN tbl_reach r ON b.rch_code = r.rch_code)
, s3 AS (SELECT s2.*, b.rch_code AS reach FROM s2
         LEFT JOIN b ON s2.rvr_code = b.rvr_code AND s2.mid_rmi >= b.min_rmi AND s2.mid_rmi < b.max_rmi)
SELECT s3.SampleNumber AS site_id, StudyCode AS project_code, CAST(year(StartDateTime) AS INTEGER) AS year, rvr_name,
  t.rch_name, s3.rvr_code, reach AS rch_code, Pass AS pass, StartDateTime AS startdatetime, EndDateTime AS enddatetime,
  StartRMI AS start_rmi, EndRMI AS end_rmi, ElectrofishingSeconds AS el_sec, Shoreline AS shoreline, Boat AS boat,
  Crew AS crew, Notes AS site_notes, Conductivity AS cond_amb, CAST(NULL AS INTEGER) AS cond_spec,
  RiverTemperature AS rvr_temp, Turbidity AS secchi, CAST(NULL AS VARCHAR) AS water_notes, principal, agency,
  GearCode AS gear, {AS_OF_SQL} AS last_modified
FROM s3 JOIN tbl_reach t ON s3.reach = t.rch_code AND s3.rvr_code = t.rvr_code""")(_q_site)

_NTF_SQL = """
, n AS (SELECT n.SampleNumber AS site_id, n.DateTime AS datetime, n.RiverMile AS rmi, n.Species AS spp_code,
    s.CommonName AS com_name, s.ScientificName AS sci_name, n.Length AS tot_length, n.Weight AS weight, n.Sex AS sex,
    n.Ripe AS ripe, CAST(NULL AS VARCHAR) AS tubercles, CAST(NULL AS INTEGER) AS ray_ct, n.DispositionType AS disp_code,
    n.UTMX AS loc_x, n.UTMY AS loc_y, CASE WHEN n.UTMX IS NOT NULL THEN 32612 END AS epsg, n.FloyTag1 AS floy_num_1,
    n.FloyTag1Color AS floy_color_1, n.Recap1 AS floy_recap_1, n.FloyTag2 AS floy_num_2,
    n.FloyTag2Color AS floy_color_2, n.Recap2 AS floy_recap_2, n.Notes AS fish_notes
  FROM wh_ntf n JOIN wh_species s ON n.Species = s.Code WHERE n.SampleNumber IN (SELECT SampleNumber FROM sp))"""
_RARE_SQL = """
, r AS (SELECT e.SampleNumber AS site_id, e.EncounterDateTime AS datetime, e.RiverMile AS rmi, s.Code AS spp_code,
    s.CommonName AS com_name, s.ScientificName AS sci_name, e.Length AS tot_length, e.Weight AS weight, x.Code AS sex,
    e.RipeFlag AS ripe, e.TuberclesFlag AS tubercles, e.RayCount AS ray_ct, d.Code AS disp_code, e.UTMX AS loc_x,
    e.UTMY AS loc_y, CASE WHEN e.UTMX IS NOT NULL THEN 32612 END AS epsg, e.Notes AS fish_notes,
    e.Recapture AS pit_recap, tg.TagCode AS pit_num, tt.TagType AS pit_type
  FROM wh_encounter e LEFT JOIN wh_individual i ON e.IndividualID = i.ID
  LEFT JOIN wh_tag tg ON e.IndividualID = tg.IndividualID LEFT JOIN wh_tag_type tt ON tg.TagType = tt.ID
  LEFT JOIN wh_species s ON i.SpeciesID = s.ID LEFT JOIN wh_disposition d ON e.DispositionTypeID = d.ID
  LEFT JOIN wh_sex x ON i.Sex = x.ID WHERE e.SampleNumber IN (SELECT SampleNumber FROM sp))"""
_FISH_TABLES = ("wh_species", "wh_individual", "wh_encounter", "wh_tag", "wh_tag_type", "wh_disposition", "wh_sex",
                "wh_ntf")

register("dp_wh_ntf", W(*_SP_TABLES, *_FISH_TABLES) + _SP_SQL + _NTF_SQL + "\nSELECT * FROM n")(
    lambda spark, d: wh.wh_untagged(wh_tables(T(spark, d)), _site_p(T(spark, d))))

register("dp_wh_rare", W(*_SP_TABLES, *_FISH_TABLES) + _SP_SQL + _RARE_SQL + "\nSELECT * FROM r")(
    lambda spark, d: wh.wh_rare(wh_tables(T(spark, d)), _site_p(T(spark, d))))


def _q_fish(spark, d):
    t = T(spark, d)
    site_p = _site_p(t)
    return wh.wh_fish(wh.wh_rare(wh_tables(t), site_p), wh.wh_untagged(wh_tables(t), site_p))


register("dp_wh_fish", W(*_SP_TABLES, *_FISH_TABLES) + _SP_SQL + _NTF_SQL + _RARE_SQL + """
, u AS (SELECT * FROM r UNION ALL BY NAME SELECT * FROM n)
SELECT * EXCLUDE (floy_recap_1, floy_recap_2, pit_recap), nullif(floy_recap_1, 0) AS floy_recap_1,
  nullif(floy_recap_2, 0) AS floy_recap_2, coalesce(pit_recap, false) AS pit_recap FROM u""")(_q_fish)


def _q_scan(spark, d):
    """Land the warehouse tables, scan them back with the projections the products use,
    and build the year/project site pointer from the scans."""
    from pyspark.sql import functions as F

    from .session import scratch_path
    from .sources.files import read_warehouse
    t = T(spark, d)
    root = scratch_path(spark, "warehouse")
    for n in _WH:
        t[f"wh_{n}"].write.parquet(f"{root}/{n}")
    scans = {n: read_warehouse(spark, root, n) for n in _WH}
    scans["person"] = read_warehouse(spark, root, "person", {"ID": "ID", "FirstName": "FirstName",
                                                              "LastName": "LastName"})
    scans["study"] = read_warehouse(spark, root, "study", ["ID", "Code", "Name"])
    return wh.site_pointer(scans, YEAR, PROJECT).select(
        "SampleNumber", "StudyCode", "GearCode", "OrgName", "rvr_code", "rvr_name", "FirstName", "LastName",
        F.col("StartDateTime").alias("start"), "Pass", "ElectrofishingSeconds")


register("src_warehouse_scan", W(*_SP_TABLES) + _SP_SQL + """
SELECT SampleNumber, StudyCode, GearCode, OrgName, rvr_code, rvr_name, FirstName, LastName, StartDateTime AS start,
  Pass, ElectrofishingSeconds FROM sp""")(_q_scan)
