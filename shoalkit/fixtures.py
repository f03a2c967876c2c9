"""Adapter: survey-domain tables derived from the driver's TPC-H-like parquet tables.

Each table is one SELECT body. On Spark it runs through ``spark.sql(body, name=df)``
with DataFrame arguments (no global views); for the DuckDB oracle the same bodies are
stitched into a ``WITH`` prefix over the pre-registered views. Because the text is
shared, the adapter itself is identical on both engines; what the oracle checks is the
operator code in ``shoalkit`` against independently written SQL.

Store-shaped tables (site, fish, pittag, floytag, water_qual, meta, daily) follow
FIXTURES.md section 4. Raw capture tables (raw_*) are the DBF-shaped inputs of the
ETL: text dates and times, "Z" and 0 sentinels, lower-case codes. Dimension tables
(reach bounds, reaches, rivers, species, life-stage bounds) are caller parameters in
the library; here they are small VALUES lists or derived from ``region``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# Reach river-mile bounds used by the quality rules
# (ECHO 319.9-344.4, DESO 128.5-215.8, LGR 0-128.5, LCO 0-110.5, WW 110.5-127.6, LSJ 0-53).
REACH_BOUNDS_ROWS = [
    ("ECHO", 319.9, 344.4),
    ("DESO", 128.5, 215.8),
    ("LGR", 0.0, 128.5),
    ("LCO", 0.0, 110.5),
    ("WW", 110.5, 127.6),
    ("LSJ", 0.0, 53.0),
]

BODIES: dict[str, str] = {
    "site": """
  SELECT CAST(o_orderkey AS STRING) AS site_id, o_orderkey AS key_a,
    lower(c_mktsegment) AS project_code, CAST(year(o_orderdate) AS INT) AS year,
    r_name AS river,
    CASE c_nationkey % 7 WHEN 0 THEN 'ECHO' WHEN 1 THEN 'DESO' WHEN 2 THEN 'LGR' WHEN 3 THEN 'LCO' WHEN 4 THEN 'WW' WHEN 5 THEN 'LSJ' ELSE 'OT' END AS reach,
    CAST(1 + o_orderkey % 3 AS INT) AS pass, o_orderdate AS startdatetime,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 HOUR END AS enddatetime,
    CASE o_orderkey % 7 WHEN 0 THEN 'R' WHEN 1 THEN 'L' WHEN 2 THEN 'B' WHEN 3 THEN 'UNK' WHEN 4 THEN 'X' WHEN 5 THEN NULL ELSE 'OT' END AS shoreline,
    CASE WHEN o_orderkey % 211 = 0 THEN 0 ELSE CAST(floor(o_totalprice / 50) AS INT) END AS el_sec,
    CAST(floor(o_totalprice / 50) AS INT) + CAST(o_orderkey % 5 - 1 AS INT) * 60 AS elapsed_sec,
    (o_orderkey % 3500) / CAST(10 AS DOUBLE) AS start_rmi,
    (o_orderkey % 3500 - o_custkey % 70 + 5) / CAST(10 AS DOUBLE) AS end_rmi,
    concat('B', CAST(o_custkey % 3 AS STRING)) AS boat, nullif(o_orderpriority, '5-LOW') AS crew,
    CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS site_notes, CAST(1 + o_orderkey % 4 AS INT) AS upload_id
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fish": """
  SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS fish_id,
    CASE WHEN l_orderkey % 97 = 0 THEN concat('X', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS site_id,
    l_orderkey AS key_a, l_shipdate AS datetime,
    (l_partkey % 3500) / CAST(10 AS DOUBLE) AS rmi,
    CASE l_partkey % 11 WHEN 0 THEN 'SM' WHEN 1 THEN 'SM' WHEN 2 THEN 'CS' WHEN 3 THEN 'RZ' WHEN 4 THEN 'HB' WHEN 5 THEN 'BT' WHEN 6 THEN 'CC' WHEN 7 THEN 'WE' WHEN 8 THEN 'NP' WHEN 9 THEN 'QQ' ELSE NULL END AS species,
    CASE WHEN l_suppkey % 107 = 0 THEN 0 ELSE CAST(nullif(l_quantity, CAST(1 AS DOUBLE)) AS INT) * 25 END AS tot_length,
    CASE WHEN l_partkey % 103 = 0 THEN 0 ELSE CAST(nullif(floor(l_extendedprice / 30), 100) AS INT) END AS weight,
    CASE l_linestatus WHEN 'F' THEN 'F' ELSE 'M' END AS sex,
    CASE l_linenumber % 4 WHEN 0 THEN 'EXP_EGG' WHEN 1 THEN 'INT_MILT' WHEN 2 THEN 'NOT' ELSE NULL END AS rep_cond,
    CASE l_suppkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Q' ELSE NULL END AS tubercles,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(l_suppkey % 20 AS STRING) END AS ray_ct,
    CASE l_returnflag WHEN 'A' THEN 'DE' WHEN 'R' THEN 'RA' ELSE NULL END AS disp,
    CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 109 = 0 THEN CAST(0 AS DOUBLE) ELSE 600000 + l_suppkey * CAST(10 AS DOUBLE) END AS loc_x,
    CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 113 = 0 THEN CAST(0 AS DOUBLE) ELSE 4200000 + l_partkey * CAST(10 AS DOUBLE) END AS loc_y,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 32612 END AS epsg,
    CASE WHEN l_partkey % 5 = 0 THEN l_linestatus END AS fish_notes,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE -111 + (l_partkey % 4000 - 2000) / CAST(1000 AS DOUBLE) END AS ilon,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 38 + (l_suppkey % 100) / CAST(100 AS DOUBLE) END AS ilat
  FROM {lineitem}""",
    "pittag": """
  SELECT concat('P', fish_id) AS pit_id, CASE WHEN key_a % 89 = 0 THEN concat('X', fish_id) ELSE fish_id END AS fish_id, site_id, species,
    CASE WHEN key_a % 2 = 0 THEN '134' ELSE '400' END AS pit_type,
    CASE WHEN key_a % 13 = 0 THEN NULL ELSE lpad(CAST(key_a AS STRING), CASE WHEN key_a % 3 = 0 THEN 14 ELSE 9 END, '0') END AS pit_num,
    CASE key_a % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'NNF' WHEN 3 THEN NULL ELSE 'UNK' END AS pit_recap,
    CASE WHEN key_a % 6 = 0 THEN 'tagged' END AS pit_notes
  FROM {fish} WHERE disp = 'RA'""",
    "floytag": """
  SELECT concat('F', fish_id) AS floy_id, CASE WHEN key_a % 83 = 0 THEN concat('X', fish_id) ELSE fish_id END AS fish_id, site_id, species,
    CASE key_a % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'YEL' WHEN 2 THEN 'GRN' ELSE NULL END AS floy_color,
    CAST(key_a AS STRING) AS floy_num,
    CASE key_a % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'UNK' END AS floy_recap,
    CASE WHEN key_a % 5 = 0 THEN CAST(key_a % 1000 AS INT) END AS floy_ref, CASE WHEN key_a % 7 = 0 THEN 'floy' END AS floy_notes
  FROM {fish} WHERE disp = 'DE'""",
    "vial": """
  SELECT concat('V', fish_id) AS vial_id, CASE WHEN key_a % 79 = 0 THEN concat('X', fish_id) ELSE fish_id END AS fish_id,
    CASE WHEN key_a % 3 = 0 THEN NULL ELSE concat('v', CAST(key_a % 1000 AS STRING)) END AS vial_num,
    CASE key_a % 5 WHEN 0 THEN 'FIN' WHEN 1 THEN 'SCA' WHEN 2 THEN 'RAY' WHEN 3 THEN 'ZZ' ELSE NULL END AS vial_type,
    CASE WHEN key_a % 4 = 0 THEN 'vial' END AS vial_notes
  FROM {fish} WHERE key_a % 10 = 0""",
    # an earlier load that the fish overlap
    "fish_earlier": "SELECT fish_id, site_id, species FROM {fish} WHERE key_a % 4 <= 1",
    "water_qual": """
  SELECT concat('W', CAST(o_orderkey AS STRING)) AS water_id,
    CASE WHEN o_orderkey % 97 = 0 THEN concat('X', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END AS site_id,
    nullif(o_custkey % 900, 0) AS cond_amb, nullif(o_custkey % 700, 0) AS cond_spec,
    (o_custkey % 250) / CAST(10 AS DOUBLE) AS rvr_temp, nullif(o_custkey % 40, 0) AS secchi,
    CASE WHEN o_custkey % 5 = 0 THEN o_orderstatus END AS water_notes
  FROM {orders} WHERE o_orderkey % 4 <> 0""",
    "meta": """
  SELECT CAST(y - 1990 AS INT) AS meta_id, CAST(y AS INT) AS year,
    CASE y % 5 WHEN 0 THEN 'machinery' WHEN 1 THEN 'building' WHEN 2 THEN 'automobile' WHEN 3 THEN 'household' ELSE 'furniture' END AS project_code,
    'Pat' AS principal_fname, CASE WHEN y = 1996 THEN NULL ELSE 'Doe' END AS principal_lname,
    CASE WHEN y = 1995 THEN 'XX' ELSE 'UDWR-M' END AS agency, CASE WHEN y = 1994 THEN 'ZZ' ELSE 'EL' END AS data_type
  FROM (SELECT DISTINCT year(o_orderdate) AS y FROM {orders}) t WHERE y <> 2001""",
    "daily": """
  SELECT CASE user_id % 3 WHEN 0 THEN '09261000' WHEN 1 THEN '09315000' ELSE '09180500' END AS staid,
    CAST(ts AS DATE) AS date,
    CASE event_type WHEN 'view' THEN '00060' WHEN 'click' THEN '00010' ELSE 'other' END AS code,
    CASE user_id % 4 WHEN 0 THEN '00011' WHEN 1 THEN '00001' ELSE '00003' END AS stat,
    CASE WHEN user_id % 11 = 0 THEN 'P' ELSE 'A' END AS qualcode, event_id, value AS val
  FROM {events}""",
    # ---- raw capture tables (DBF-shaped) ----
    "raw_site": """
  SELECT o_orderkey AS key_a, c_mktsegment AS project,
    concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) AS date,
    concat(lpad(CAST(6 + o_orderkey % 12 AS STRING), 2, '0'), ':', lpad(CAST(o_custkey % 60 AS STRING), 2, '0'), ':00') AS starttime,
    CASE WHEN o_orderkey % 50 = 0 THEN 'Z' ELSE concat(lpad(CAST(7 + o_orderkey % 12 AS STRING), 2, '0'), ':', lpad(CAST(o_custkey % 60 AS STRING), 2, '0'), ':30') END AS endtime,
    CAST(o_custkey % 100 AS INT) AS effort_min, CAST(o_orderkey % 60 AS INT) AS effort_sec,
    CASE c_nationkey % 7 WHEN 0 THEN 'ECHO' WHEN 1 THEN 'DESO' WHEN 2 THEN 'LGR' WHEN 3 THEN 'LCO' WHEN 4 THEN 'WW' WHEN 5 THEN 'LSJ' ELSE 'Z' END AS reach,
    CAST(1 + o_orderkey % 3 AS INT) AS pass,
    (o_orderkey % 3500) / CAST(10 AS DOUBLE) AS start_rmi,
    (o_orderkey % 3500 - o_custkey % 70 + 5) / CAST(10 AS DOUBLE) AS end_rmi,
    CASE o_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'L' WHEN 2 THEN 'B' ELSE 'Z' END AS shoreline,
    concat('B', CAST(o_custkey % 3 AS STRING)) AS boat,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Z' ELSE o_orderpriority END AS crew,
    o_orderstatus AS site_notes
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "raw_water": """
  SELECT concat('W', CAST(o_orderkey AS STRING)) AS key_ab, o_orderkey AS key_a,
    CAST(o_custkey % 900 AS INT) AS cond_amb, CAST(o_custkey % 700 AS INT) AS cond_spec,
    (o_custkey % 250) / CAST(10 AS DOUBLE) AS rvr_temp, CAST(o_custkey % 40 AS INT) AS secchi,
    CASE WHEN o_custkey % 5 = 0 THEN 'Z' ELSE o_orderstatus END AS h2o_notes
  FROM {orders} WHERE o_orderkey % 4 <> 0""",
    "raw_fish": """
  SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS key_aa,
    l_orderkey AS key_a,
    concat(lpad(CAST(6 + l_partkey % 12 AS STRING), 2, '0'), ':', lpad(CAST(l_suppkey % 60 AS STRING), 2, '0'), ':00') AS time,
    (l_partkey % 3500) / CAST(10 AS DOUBLE) AS rmi,
    CASE l_partkey % 11 WHEN 0 THEN 'SM' WHEN 1 THEN 'SM' WHEN 2 THEN 'CS' WHEN 3 THEN 'RZ' WHEN 4 THEN 'HB' WHEN 5 THEN 'BT' WHEN 6 THEN 'CC' WHEN 7 THEN 'WE' WHEN 8 THEN 'NP' WHEN 9 THEN 'QQ' ELSE 'Z' END AS species,
    CAST(l_quantity AS INT) * 25 - CASE WHEN l_quantity = 1 THEN 25 ELSE 0 END AS tot_length,
    CAST(l_quantity AS INT) * 22 AS st_length,
    CAST(floor(l_extendedprice / 30) AS INT) AS weight,
    CASE l_linestatus WHEN 'F' THEN 'F' ELSE 'M' END AS sex,
    CASE l_linenumber % 4 WHEN 0 THEN 'exp_egg' WHEN 1 THEN 'INT_MILT' WHEN 2 THEN 'not' ELSE 'Z' END AS rep_cond,
    CASE l_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'Z' END AS tubercles,
    CASE WHEN l_suppkey % 4 = 0 THEN 'N' ELSE CAST(l_suppkey % 20 AS STRING) END AS ray_ct,
    CASE l_returnflag WHEN 'A' THEN 'DE' WHEN 'R' THEN 'RA' ELSE 'Z' END AS disp,
    CASE WHEN l_partkey % 5 = 0 THEN 'Z' ELSE l_linestatus END AS fish_notes,
    CASE WHEN l_partkey % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE -111 + (l_partkey % 4000 - 2000) / CAST(1000 AS DOUBLE) END AS ilon,
    CASE WHEN l_partkey % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE 38 + (l_suppkey % 100) / CAST(100 AS DOUBLE) END AS ilat
  FROM {lineitem}""",
    "raw_pittag": """
  SELECT concat('P', key_aa) AS key_aaa, key_aa, key_a,
    CASE WHEN key_a % 2 = 0 THEN '134' ELSE '400' END AS pit_type,
    CASE WHEN key_a % 13 = 0 THEN NULL WHEN key_a % 17 = 0 THEN 'Z'
         ELSE concat(CASE WHEN key_a % 7 = 0 THEN 'a' ELSE 'A' END, lpad(CAST(key_a AS STRING), CASE WHEN key_a % 3 = 0 THEN 13 ELSE 8 END, '0')) END AS pit_num,
    CASE key_a % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'NNF' WHEN 3 THEN 'Z' ELSE 'UNK' END AS pit_recap,
    CASE WHEN key_a % 6 = 0 THEN 'Z' ELSE 'tagged' END AS pit_notes
  FROM {raw_fish} WHERE disp = 'RA'""",
    "raw_floytag": """
  SELECT concat('F', key_aa) AS key_aab, key_aa, key_a, 'x' AS floy_id,
    CASE key_a % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'YEL' WHEN 2 THEN 'GRN' ELSE 'Z' END AS floy_color,
    CASE WHEN key_a % 11 = 0 THEN NULL ELSE CAST(key_a AS STRING) END AS floy_num,
    CASE key_a % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'Z' END AS floy_recap,
    'floy' AS floy_notes
  FROM {raw_fish} WHERE disp = 'DE'""",
    "raw_vial": """
  SELECT concat('V', key_aa) AS key_aav, key_aa, key_a,
    CASE WHEN key_a % 3 = 0 THEN 'Z' ELSE concat('v', CAST(key_a % 1000 AS STRING)) END AS vial_num,
    CASE key_a % 4 WHEN 0 THEN 'FIN' WHEN 1 THEN 'SCA' WHEN 2 THEN 'RAY' ELSE 'Z' END AS vial_type,
    'vial' AS vial_notes
  FROM {raw_fish} WHERE key_a % 10 = 0""",
    # ---- dimension tables (caller parameters in the library) ----
    "reach_bounds": """
  SELECT rch_code, CAST(lo AS DOUBLE) AS min_rmi, CAST(hi AS DOUBLE) AS max_rmi FROM (VALUES
    ('ECHO', 319.9, 344.4), ('DESO', 128.5, 215.8), ('LGR', 0.0, 128.5),
    ('LCO', 0.0, 110.5), ('WW', 110.5, 127.6), ('LSJ', 0.0, 53.0)) AS t(rch_code, lo, hi)""",
    "tbl_reach": """
  SELECT rch_code, rch_name, rvr_code FROM (VALUES
    ('ECHO', 'Echo reach', 'GR'), ('DESO', 'Desolation reach', 'GR'), ('LGR', 'Lower Green reach', 'GR'),
    ('LCO', 'Lower Colorado reach', 'CO'), ('WW', 'Westwater reach', 'CO'), ('LSJ', 'Lower San Juan reach', 'SJ'))
    AS t(rch_code, rch_name, rvr_code)""",
    "tbl_river": """
  SELECT r_name AS rvr_code, concat(lower(r_name), ' river') AS rvr_name FROM {region} WHERE r_regionkey <> 4""",
    "tbl_spp": """
  SELECT spp_code, com_name, sci_name, nativity FROM (VALUES
    ('SM', 'smallmouth bass', 'Micropterus dolomieu', 'N'), ('CS', 'Colorado pikeminnow', 'Ptychocheilus lucius', 'Y'),
    ('RZ', 'razorback sucker', 'Xyrauchen texanus', 'Y'), ('HB', 'humpback chub', 'Gila cypha', 'Y'),
    ('BT', 'bonytail', 'Gila elegans', 'Y'), ('CC', 'channel catfish', 'Ictalurus punctatus', 'N'),
    ('WE', 'walleye', 'Sander vitreus', 'N'), ('NP', 'northern pike', 'Esox lucius', 'N'))
    AS t(spp_code, com_name, sci_name, nativity)""",
    "stage_bounds": """
  SELECT species, life_stage, CAST(lo AS INT) AS min_len, CAST(hi AS INT) AS max_len FROM (VALUES
    ('SM', 'JUV', 0, 100), ('SM', 'SUB', 100, 200), ('SM', 'ADT', 200, 100000),
    ('CS', 'JUV', 0, 300), ('CS', 'ADT', 300, 100000)) AS t(species, life_stage, lo, hi)""",
    "stations": """
  SELECT staid, sta_name, rvr_code, temp_stat FROM (VALUES
    ('09261000', 'Jensen, Utah', 'GR', '00003'), ('09315000', 'Green River, Utah', 'GR', '00011'),
    ('09180500', 'Near Cisco, Utah (Dewey)', 'CO', '00003')) AS t(staid, sta_name, rvr_code, temp_stat)""",
    # ---- normalised warehouse tables (study events, encounters, lookups) ----
    "wh_study_event": """
  SELECT o_orderkey AS ID, concat('S', CAST(o_orderkey AS STRING)) AS SampleNumber,
    CAST(1 + o_orderkey % 3 AS INT) AS StudyID, CAST(1 + o_custkey % 2 AS INT) AS GearTypeID,
    CAST(1 + c_nationkey % 5 AS INT) AS OrgID, CAST(1 + c_nationkey % 4 AS INT) AS RiverID,
    CAST(1 + o_custkey % 10 AS INT) AS PersonID, o_orderdate AS StartDateTime, o_orderdate AS EndDateTime,
    (o_orderkey % 3500) / CAST(10 AS DOUBLE) AS StartRMI,
    (o_orderkey % 3500 - o_custkey % 70 + 5) / CAST(10 AS DOUBLE) AS EndRMI,
    CAST(1 + o_orderkey % 3 AS INT) AS Pass, CAST(floor(o_totalprice / 50) AS INT) AS ElectrofishingSeconds,
    CASE o_orderkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'L' ELSE 'B' END AS Shoreline,
    concat('B', CAST(o_custkey % 3 AS STRING)) AS Boat, o_orderpriority AS Crew, o_orderstatus AS Notes,
    CAST(o_custkey % 900 AS INT) AS Conductivity, (o_custkey % 250) / CAST(10 AS DOUBLE) AS RiverTemperature,
    CAST(o_custkey % 40 AS INT) AS Turbidity
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "wh_study": """
  SELECT ID, Code, Name FROM (VALUES (1, '123a', 'Humpback chub monitoring'), (2, '123d', 'Walleye removal'),
    (3, '138', 'Smallmouth bass removal')) AS t(ID, Code, Name)""",
    "wh_gear": "SELECT ID, Code FROM (VALUES (1, 'EL'), (2, 'EH')) AS t(ID, Code)",
    "wh_org": """
  SELECT CAST(n_nationkey + 1 AS INT) AS ID, concat(n_name, ' wildlife ', lower(n_name)) AS Name
  FROM {nation} WHERE n_nationkey < 5""",
    "wh_hydro": """
  SELECT ID, Code, Name, BasinID FROM (VALUES (1, 'GR', 'Green River', 1), (2, 'CO', 'Colorado River', 1),
    (3, 'SJ', 'San Juan River', 1), (4, 'OT', 'Other', 2)) AS t(ID, Code, Name, BasinID)""",
    "wh_person": """
  SELECT CAST(c_custkey AS INT) AS ID, concat('First', CAST(c_custkey AS STRING)) AS FirstName, c_name AS LastName
  FROM {customer} WHERE c_custkey <= 10""",
    "wh_species": """
  SELECT ID, Code, CommonName, ScientificName FROM (VALUES (1, 'SM', 'smallmouth bass', 'Micropterus dolomieu'),
    (2, 'CS', 'Colorado pikeminnow', 'Ptychocheilus lucius'), (3, 'RZ', 'razorback sucker', 'Xyrauchen texanus'),
    (4, 'HB', 'humpback chub', 'Gila cypha'), (5, 'BT', 'bonytail', 'Gila elegans'),
    (6, 'CC', 'channel catfish', 'Ictalurus punctatus'), (7, 'WE', 'walleye', 'Sander vitreus'),
    (8, 'NP', 'northern pike', 'Esox lucius')) AS t(ID, Code, CommonName, ScientificName)""",
    "wh_individual": """
  SELECT p_partkey AS ID, CAST(2 + p_partkey % 4 AS INT) AS SpeciesID, CAST(1 + p_partkey % 3 AS INT) AS Sex FROM {part}""",
    "wh_encounter": """
  SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS ID,
    l_partkey AS IndividualID, concat('S', CAST(l_orderkey AS STRING)) AS SampleNumber, l_shipdate AS EncounterDateTime,
    (l_partkey % 3500) / CAST(10 AS DOUBLE) AS RiverMile, CAST(l_quantity AS INT) * 25 AS Length,
    CAST(floor(l_extendedprice / 30) AS INT) AS Weight, CASE l_linenumber % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS RipeFlag,
    CASE l_suppkey % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS TuberclesFlag, CAST(l_suppkey % 20 AS INT) AS RayCount,
    CAST(1 + l_linenumber % 3 AS INT) AS DispositionTypeID,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 600000 + l_suppkey * CAST(10 AS DOUBLE) END AS UTMX,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 4200000 + l_partkey * CAST(10 AS DOUBLE) END AS UTMY,
    l_linestatus AS Notes, l_orderkey % 2 = 0 AS Recapture
  FROM {lineitem} WHERE l_partkey % 11 IN (2, 3, 4, 5)""",
    "wh_tag": """
  SELECT p_partkey AS ID, p_partkey AS IndividualID, CAST(1 + p_partkey % 2 AS INT) AS TagType,
    lpad(CAST(p_partkey AS STRING), 9, '0') AS TagCode FROM {part} WHERE p_partkey % 3 <> 0""",
    "wh_tag_type": "SELECT ID, TagType FROM (VALUES (1, '134'), (2, '400')) AS t(ID, TagType)",
    "wh_disposition": "SELECT ID, Code FROM (VALUES (1, 'RA'), (2, 'DE'), (3, 'TR')) AS t(ID, Code)",
    "wh_sex": "SELECT ID, Code FROM (VALUES (1, 'M'), (2, 'F'), (3, 'U')) AS t(ID, Code)",
    "wh_ntf": """
  SELECT concat('S', CAST(l_orderkey AS STRING)) AS SampleNumber, l_shipdate AS DateTime,
    (l_partkey % 3500) / CAST(10 AS DOUBLE) AS RiverMile,
    CASE l_partkey % 11 WHEN 6 THEN 'CC' WHEN 7 THEN 'WE' WHEN 8 THEN 'NP' WHEN 9 THEN 'QQ' ELSE 'SM' END AS Species,
    CAST(l_quantity AS INT) * 25 AS Length, CAST(floor(l_extendedprice / 30) AS INT) AS Weight,
    CASE l_linestatus WHEN 'F' THEN 'F' ELSE 'M' END AS Sex, 'N' AS Ripe,
    CASE l_returnflag WHEN 'A' THEN 'DE' WHEN 'R' THEN 'RA' ELSE 'TR' END AS DispositionType,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 600000 + l_suppkey * CAST(10 AS DOUBLE) END AS UTMX,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 4200000 + l_partkey * CAST(10 AS DOUBLE) END AS UTMY,
    CASE WHEN l_orderkey % 4 = 0 THEN CAST(l_orderkey AS STRING) END AS FloyTag1,
    CASE WHEN l_orderkey % 4 = 0 THEN 'RED' END AS FloyTag1Color, CAST(l_orderkey % 3 AS INT) AS Recap1,
    CAST(NULL AS STRING) AS FloyTag2, CAST(NULL AS STRING) AS FloyTag2Color, CAST(l_orderkey % 2 AS INT) AS Recap2,
    l_linestatus AS Notes
  FROM {lineitem} WHERE l_partkey % 11 NOT IN (2, 3, 4, 5)""",
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return _REF.findall(BODIES[name])


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in out:
            return
        for d in deps(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_prefix(*names: str) -> str:
    """``WITH`` prefix defining the named adapter tables (and what they need) for DuckDB."""
    parts = []
    for n in _closure(names):
        body = _REF.sub(lambda m: m.group(1), BODIES[n])
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"


class Tables:
    """Lazy, cached adapter DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                args = {d: self[d] for d in deps(name)}
                df = self.spark.sql(BODIES[name], **args)
            self._cache[name] = df
        return self._cache[name]


_TABLES: dict[tuple, Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (id(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]
