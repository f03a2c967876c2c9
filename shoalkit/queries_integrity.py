"""Queries: integrity checks, batch load, sinks and file sources.

Sink and load keys write to a fresh folder under the session's shared checkpoint
folder, read the result back and return it; their oracle is the source rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F

from . import queries_core  # noqa: F401 - its SQL is part of the release's
from .catalog import AS_OF_SQL, ORACLE, T, W, register
from .operators import integrity as ck
from .operators.clean import sentinel_to_null
from .plans import etl, load
from .queries_quality import FISH_QC_SQL, PIT_QC_SQL, SITE_QC_SQL, _fish_inputs, site_input
from .queries_relational import _EFFORT_SQL
from .session import in_turn, scratch_path, sealed, sealed_in_turns, settled, turns
from .sources import files, sinks, store

def _v(table, rule, col, key, n, sev="error"):
    return f"""'{table}' AS "table", '{rule}' AS rule, '{col}' AS "column", {key} AS key, {n} AS n, '{sev}' AS severity"""


# ------------------------------------------------------------------ primary keys
def _line_key():
    parts = F.split("fish_id", "-")
    return F.concat_ws("-", F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2)))


_PK = [("meta", "meta_id"), ("site", "site_id"), ("water_qual", "water_id"), ("fish", "fish_id"), ("pittag", "pit_id"),
       ("floytag", "floy_id"), ("vial", "vial_id")]
_ALL = tuple(t for t, _ in _PK)


def _q_pk(spark, d):
    """Keys repeated within each table, and fish that an earlier load holds (found by the key index)."""
    t = T(spark, d)
    lines = t.fish.select(_line_key().alias("line_key"))
    root = scratch_path(spark, "store")
    store.append(spark, {"fish": t.fish_earlier}, root)
    held = store.with_keys(spark, root, "fish", t.fish.select("fish_id"))
    return ck.union_all([
        ck.check_unique(lines, "fish", ["line_key"], rule="primary_key"),
        *[ck.check_unique(t[n], n, [c], held if n == "fish" else None, rule="primary_key") for n, c in _PK]])


register("ck_primary_key", W(*_ALL, "fish_earlier") + f"""
, l AS (SELECT split_part(fish_id, '-', 1) || '-' || split_part(fish_id, '-', 2) AS line_key FROM fish)
SELECT {_v("fish", "primary_key", "line_key", "line_key", "count(*)")} FROM l GROUP BY line_key HAVING count(*) > 1
UNION ALL SELECT {_v("fish", "primary_key_store", "fish_id", "fish_id", "count(*)")} FROM fish
  WHERE fish_id IN (SELECT fish_id FROM fish_earlier) GROUP BY fish_id
""" + "\n".join(f"""UNION ALL SELECT {_v(n, "primary_key", c, f"CAST({c} AS VARCHAR)", "count(*)")} FROM {n}
  WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1""" for n, c in _PK))(_q_pk)


def _q_unique(spark, d):
    s = T(spark, d).site
    return ck.union_all([ck.check_unique(s, "meta", ["year"]),
                         ck.check_unique(s, "meta", ["project_code", "year"])])


register("ck_unique", W("site") + f"""
SELECT {_v("meta", "unique", "year", "CAST(year AS VARCHAR)", "count(*)")} FROM site WHERE year IS NOT NULL
  GROUP BY year HAVING count(*) > 1
UNION ALL SELECT {_v("meta", "unique", "project_code,year", "project_code || '|' || CAST(year AS VARCHAR)", "count(*)")}
  FROM site WHERE project_code IS NOT NULL AND year IS NOT NULL GROUP BY project_code, year HAVING count(*) > 1""")(_q_unique)

# ------------------------------------------------------------------ NOT NULL / domain / non-zero
# The store's NOT NULL columns and value lists, written out for the oracle.
_NN = {
    "meta": "meta_id project_code year principal_fname principal_lname agency data_type",
    "site": "site_id project_code year river reach start_rmi end_rmi startdatetime enddatetime shoreline el_sec upload_id",
    "water_qual": "water_id site_id",
    "fish": "fish_id site_id rmi species disp",
    "pittag": "pit_id fish_id pit_recap pit_num pit_type",
    "floytag": "floy_id fish_id floy_num floy_recap",
    "vial": "vial_id fish_id vial_type",
}
_LISTS = [
    ("meta", "agency", "UDWR-M UDWR-V CSU FWS-GJ FWS-V"), ("meta", "data_type", "EL SE TR ANT OT"),
    ("site", "river", "CO GR SJ LP DO PR SR OT"),
    ("site", "reach", "LGR LCO WW DESO LDO MGR ECHO MATH USJ MSJ LSJ LPCO LPSJ LSR LPR OT"),
    ("site", "shoreline", "R L B OT UNK"), ("fish", "species", " ".join(ck.SPECIES)), ("fish", "disp", "DE RT FC HA DF SS DP RA TR TL UNK OT"),
    ("pittag", "pit_recap", "Y N NNF UNK"), ("pittag", "pit_type", "134 400"), ("floytag", "floy_recap", "Y N UNK"),
    ("floytag", "floy_color", "PUR BRN WHT RED YEL GRN OR GRY CL OT"),
    ("vial", "vial_type", "LF UIF FIN RAY SCA EYE BLD STO GUT OTO MUS OT"),
]
_MEASURES = [("site", "el_sec"), ("fish", "tot_length"), ("fish", "weight"), ("fish", "loc_x"), ("fish", "loc_y")]


def _by_rules(kind, tables=_ALL):
    """One scan a table for all rules of one kind."""
    def q(spark, d):
        t = T(spark, d)
        named = [n for n in tables if ck.STORE_RULES[n].get(kind)]
        return ck.union_all([ck.check_rules(t[n], n, **{kind: _error_lists(n) if kind == "domain" else ck.STORE_RULES[n][kind]}) for n in named])
    return q


def _error_lists(table):
    return {c: v for c, v in ck.STORE_RULES[table]["domain"].items() if None not in v}


register("ck_not_null", W(*_ALL) + "\nUNION ALL ".join(
    f"SELECT {_v(t, 'not_null', c, 'CAST(NULL AS VARCHAR)', 'count(*)')} FROM {t} WHERE {c} IS NULL HAVING count(*) > 0"
    for t, cols in _NN.items() for c in cols.split()))(_by_rules("not_null"))


def _dom_sql(table, col, values, sev="error", src=None):
    lst = ", ".join(f"'{v}'" for v in values if v is not None)
    return (f"SELECT {_v(table, 'domain', col, col, 'count(*)', sev)} FROM {src or table} "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN ({lst}) GROUP BY {col}")


register("ck_domain", W("meta", "site", "fish", "pittag", "floytag", "vial") + "\nUNION ALL ".join(
    _dom_sql(t, c, v.split()) for t, c, v in _LISTS))(_by_rules("domain"))

_NULL_LISTS = [("sex", ck.SEXES), ("rep_cond", ck.REP_CONDS), ("tubercles", ck.TUBERCLES)]
register("ck_domain_null_list", W("raw_fish") + """
, rf AS (SELECT nullif(sex, 'Z') AS sex, nullif(rep_cond, 'Z') AS rep_cond, nullif(tubercles, 'Z') AS tubercles FROM raw_fish)
""" + "\nUNION ALL ".join(_dom_sql("fish", c, v, "warn", "rf") for c, v in _NULL_LISTS))(
    lambda spark, d: ck.check_rules(sentinel_to_null(T(spark, d).raw_fish), "fish", domain=dict(_NULL_LISTS)))

register("ck_nonzero", W("site", "fish") + "\nUNION ALL ".join(
    f"SELECT {_v(t, 'nonzero', c, 'CAST(NULL AS VARCHAR)', 'count(*)')} FROM {t} WHERE {c} = 0 HAVING count(*) > 0"
    for t, c in _MEASURES))(_by_rules("nonzero"))


# ------------------------------------------------------------------ foreign keys
_FK = [("site", ["project_code", "year"], "meta"), ("water_qual", ["site_id"], "site"), ("fish", ["site_id"], "site"),
       ("pittag", ["fish_id"], "fish"), ("floytag", ["fish_id"], "fish"), ("vial", ["fish_id"], "fish")]


def _q_fk(spark, d):
    """All six keys; the parents of water and fish are held by the store and found by its key index."""
    t = T(spark, d)
    root = scratch_path(spark, "store")
    store.append(spark, {"site": t.site}, root)
    sites = t.water_qual.select("site_id").union(t.fish.select("site_id"))
    parents = {"meta": t.meta, "fish": t.fish, "site": store.with_keys(spark, root, "site", sites)}
    return ck.union_all([ck.check_foreign_key(t[c], parents[p], cols, table=c) for c, cols, p in _FK])


def _fk_sql(child, cols, parent):
    key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NA')" for c in cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    match = " AND ".join(f"p.{c} = c.{c}" for c in cols)
    return (f"SELECT {_v(child, 'foreign_key', ','.join(cols), key, 'count(*)')} FROM {child} c WHERE {nn} "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match}) GROUP BY {', '.join(cols)}")


register("ck_foreign_key", W(*_ALL) + "\nUNION ALL ".join(_fk_sql(*k) for k in _FK))(_q_fk)


# ------------------------------------------------------------------ load
def _q_upload_id(spark, d):
    t = T(spark, d)
    # the whole site table arrives as a new batch on top of a store holding it
    return load.assign_upload_id(t.site.drop("upload_id"), t.site)


register("ld_upload_id", W("site") + """
SELECT * EXCLUDE (upload_id), (SELECT CAST(coalesce(max(upload_id), 0) + 1 AS INTEGER) FROM site) AS upload_id
FROM site""")(_q_upload_id)


#: Tables of ``proofed_batch`` that are read from files, stripped or not.
_AT_REST = ("site", "fish", "pittag", "floytag")


def proofed_batch(t):
    """The ETL tables with their QC flags, as the proofing step receives them."""
    from .operators import quality as qc
    # site and fish feed several tables: written once to the shared scratch folder,
    # which also cuts their long lineage out of every later plan
    site = settled(lambda: etl.build_site(t.raw_site, t.tbl_reach), "site")
    samp_n = etl.key_map(site)
    fish = settled(lambda: etl.build_fish(t.raw_fish, samp_n), "fish")
    # whole fish rows move to their sites' ids: a large table in turns of them
    n = turns(fish.count())
    fish_ck = sealed_in_turns(lambda k: qc.fish_qc(in_turn(fish, ["site_id"], k, n), in_turn(site, ["site_id"], k, n)), n, "fish-qc")
    return {
        "meta": etl.meta_rows(t.raw_site, "Pat", "Doe", "UDWR-M", "EL"),
        "site": qc.site_qc(site),
        "water_qual": etl.build_water(t.raw_water, samp_n),
        "fish": fish_ck,
        "pittag": settled(lambda: qc.pit_qc(etl.build_tags(t.raw_pittag, samp_n, fish, "pit"), fish), "pittag"),
        "floytag": settled(lambda: qc.floy_qc(etl.build_tags(t.raw_floytag, samp_n, fish, "floy")), "floytag"),
    }


def _q_batch(spark, d):
    violations, _, _ = load.load_batch(spark, proofed_batch(T(spark, d)), scratch_path(spark, "store"),
                                       number_meta=True, at_rest=_AT_REST)
    return violations


def _q_batch_loaded(spark, d):
    """The batch without the rows that break a rule, loaded in one commit and read back."""
    raw = proofed_batch(T(spark, d))
    raw["meta"] = load.assign_meta_ids(raw["meta"], None)
    clean, _ = load.proof_batch(load.strip_batch(raw, 1), _AT_REST)
    root = scratch_path(spark, "store")
    violations, written, _ = load.load_batch(spark, clean, root, at_rest=clean)
    if written != list(clean):
        raise RuntimeError(f"refused: {violations.limit(5).collect()}")
    got = load.read_store_tables(spark, root)
    return ck.union_all([got[n].select(F.lit(n).alias("tbl"), F.col(key).cast("string").alias("key"), F.col(parent).cast("string").alias("parent"),
                                       F.col(what).cast("string").alias("what")) for n, (key, parent, what) in _READ_BACK.items()])


#: Key, parent's key and one more column of each table that is read back.
_READ_BACK = {"meta": ("meta_id", "project_code", "year"), "site": ("site_id", "project_code", "el_sec"), "water_qual": ("water_id", "site_id", "secchi"),
              "fish": ("fish_id", "site_id", "species"), "pittag": ("pit_id", "fish_id", "pit_num"), "floytag": ("floy_id", "fish_id", "floy_num")}


# ------------------------------------------------------------------ sinks and file sources
_SITE_COLS = ["site_id", "project_code", "year", "reach", "pass", "startdatetime", "el_sec", "start_rmi", "crew"]
_SITE_SQL = "SELECT " + ", ".join(_SITE_COLS) + " FROM site"


def _site_cols(t):
    return t.site.select(*_SITE_COLS)


def _q_csv_na(spark, d):
    src = _site_cols(T(spark, d))
    path = sinks.write_product(src, scratch_path(spark, "product"))
    return files.read_sheet(spark, path, "", src.schema)


register("snk_csv_na", W("site") + _SITE_SQL)(_q_csv_na)


def _q_store_scan(spark, d):
    src = _site_cols(T(spark, d))
    root = scratch_path(spark, "store")
    sinks.append_batch({"site": src}, root)
    return files.read_store(spark, root, "site")


register("src_table_scan", W("site") + _SITE_SQL)(_q_store_scan)


def _q_append(spark, d):
    """Two loads, and a third that dies before its commit: nothing of it is read."""
    src = _site_cols(T(spark, d)).withColumn("upload_id", F.lit(0))
    root = scratch_path(spark, "store")
    sinks.append_batch({"site": src.filter(F.col("pass") == 1)}, root)
    store.stage(spark, src, root, "site", "dead")
    sinks.append_batch({"site": src.filter(F.col("pass") != 1)}, root)
    return files.read_store(spark, root, "site")


register("snk_append_store", W("site") + "SELECT " + ", ".join(_SITE_COLS) + ", 0 AS upload_id FROM site")(_q_append)


def _named_rows(named, name="tbl"):
    """Tables as one, by column name, with the table's name."""
    parts = [df.withColumn(name, F.lit(n)) for n, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _q_snapshot(spark, d):
    """Every table as a second snapshot names it, after a load that came later."""
    t = T(spark, d)
    root, archive = scratch_path(spark, "store"), scratch_path(spark, "archive")
    sinks.append_batch({n: t[n] for n in ("meta", "site", "water_qual", "fish")}, root)
    sinks.snapshot_store(spark, root, archive, "20201230", 4)
    sinks.append_batch({n: t[n] for n in ("pittag", "floytag", "vial")}, root)
    snap = sinks.snapshot_store(spark, root, archive, "20201231", 5)
    sinks.append_batch({"vial": t.vial}, root)
    return _named_rows({n: store.read_snapshot(spark, snap, n) for n in _ALL})


register("snk_snapshot", W(*_ALL) + "\nUNION ALL BY NAME ".join(f"SELECT *, '{n}' AS tbl FROM {n}" for n in _ALL))(_q_snapshot)


def _q_bundle(spark, d):
    """All sheets of the proofing bundle, read back by value."""
    from .operators import quality as qc
    from .plans import effort
    t = T(spark, d)
    site, fish = _fish_inputs(t)
    pit_parent = t.fish.select(F.col("key_a").alias("f_index"), "fish_id", "species")
    pit = t.pittag.select("pit_id", "fish_id", "site_id", "species", "pit_type", "pit_num", "pit_recap")
    named = {"meta": t.meta, "stats": effort.effort_stats(t.site, t.fish, ["SM"], ["pass"]), "ck_site": qc.site_qc(site_input(t)),
             "ck_fish": qc.fish_qc(fish, site), "ck_pit": qc.pit_qc(pit, pit_parent), "water": t.water_qual}
    paths = sinks.write_bundle(named, scratch_path(spark, "bundle"))
    return _named_rows({n: files.read_sheet(spark, paths[n], "", named[n].schema) for n in named}, "sheet")


register("snk_qc_bundle", W("meta", "site", "fish", "pittag", "water_qual") + SITE_QC_SQL + FISH_QC_SQL + PIT_QC_SQL + f"""
, st AS ({_EFFORT_SQL.format(keys="s.pass", catch="catch", extra=", 'SM' AS species", site="site").replace(", f AS (", "WITH fs AS (", 1).replace("JOIN f ON s.site_id = f.site_id", "JOIN fs f ON s.site_id = f.site_id")})
SELECT *, 'meta' AS sheet FROM meta UNION ALL BY NAME SELECT *, 'stats' AS sheet FROM st
UNION ALL BY NAME SELECT *, 'ck_site' AS sheet FROM q UNION ALL BY NAME SELECT *, 'ck_fish' AS sheet FROM qf
UNION ALL BY NAME SELECT *, 'ck_pit' AS sheet FROM qp UNION ALL BY NAME SELECT *, 'water' AS sheet FROM water_qual""")(_q_bundle)


def _q_sheet(spark, d):
    from .operators import quality as qc
    t = T(spark, d)
    ck_site = qc.site_qc(site_input(t))
    paths = sinks.write_bundle({"ck_site": ck_site}, scratch_path(spark, "bundle"))
    bundle = paths["ck_site"].rsplit("/", 1)[0]
    return files.read_sheet(spark, bundle, "ck_site", ck_site.schema)


register("src_sheet_scan", W("site") + SITE_QC_SQL + "SELECT * FROM q")(_q_sheet)


_PROJECT, _YEAR = "household", 1998


def _q_release(spark, d):
    """The six products of a project and year, released twice; the second is read, checked file by file."""
    from .plans import effort, products
    t = T(spark, d)
    # the project's sites and the products that joins make are computed once, for both releases
    site = sealed(t.site.filter(F.col("project_code") == _PROJECT), "site")
    site_p = sealed(products.site_pointer(site, t.tbl_river, t.tbl_reach, t.water_qual, t.meta, [_YEAR]), "site-pointer")
    make = {"site": lambda: sealed(products.site_product(site, t.tbl_river, t.tbl_reach, t.water_qual, t.meta, [_YEAR])),
            "fish": lambda: sealed(products.fish_product(t.fish, site_p, t.pittag, t.tbl_spp)), "floy": lambda: products.floy_product(t.floytag),
            "cpue": lambda: sealed(effort.cpue(site, t.fish, [_YEAR])),
            "cpue_ls": lambda: sealed(effort.cpue_life_stage(site, t.fish, t.stage_bounds, ["SM"], [_YEAR])),
            "usgswater": lambda: sealed(products.water_product(t.daily, t.stations, 2024))}
    with ThreadPoolExecutor(max_workers=4) as pool:  # products are made independently of each other
        named = dict(zip(make, pool.map(lambda f: f(), make.values())))
    path = scratch_path(spark, "release")
    sinks.write_release({n: df.limit(1) for n, df in named.items()}, path, _PROJECT, _YEAR)
    sinks.write_release(named, path, _PROJECT, _YEAR)
    return _named_rows({n: files.read_release(spark, path, _PROJECT, _YEAR, n) for n in named}, "product")


def _release_sql():
    """The products' SQL, over the project's sites where they aren't the project's already.

    The products' CSV has one mark, NA, for NULL and the life stage of that name."""
    from .queries_products import _SITE_P_SQL, _SITE_P_TABLES
    own = f"'{_PROJECT}' AS project_code, {_YEAR} AS year"
    tables = (*_SITE_P_TABLES, "fish", "pittag", "tbl_spp", "floytag", "stage_bounds", "daily", "stations")

    def inner(key, *names):
        sql = ORACLE[key].removeprefix(W(*names)).strip().removeprefix(",")
        return "(WITH " + sql.replace("FROM site WHERE year", f"FROM site WHERE project_code = '{_PROJECT}' AND year") + ")"

    return W(*tables) + _SITE_P_SQL + f"""
SELECT *, {AS_OF_SQL} AS last_modified, 'site' AS product FROM sp
UNION ALL BY NAME SELECT *, {own}, 'fish' AS product FROM {inner("dp_fish", *_SITE_P_TABLES, "fish", "pittag", "tbl_spp")}
UNION ALL BY NAME SELECT *, {own}, 'floy' AS product FROM floytag
UNION ALL BY NAME SELECT *, {own}, 'cpue' AS product FROM {inner("dp_cpue", "site", "fish")}
UNION ALL BY NAME SELECT * REPLACE (nullif(life_stage, 'NA') AS life_stage), {own}, 'cpue_ls' AS product FROM {inner("dp_cpue_life_stage", "site", "fish", "stage_bounds")}
UNION ALL BY NAME SELECT *, {own}, 'usgswater' AS product FROM {inner("dp_water", "daily", "stations")}"""


register("snk_release_bundle", _release_sql())(_q_release)


def _q_csv_infer(spark, d):
    t = T(spark, d)
    src = t.site.select("project_code", "year", "start_rmi", "crew", "el_sec")
    path = sinks.write_product(src, scratch_path(spark, "csv"))
    return files.read_csv(spark, path)


register("src_csv_infer", W("site") + "SELECT project_code, year, start_rmi, crew, el_sec FROM site")(_q_csv_infer)


def _q_dbf(spark, d):
    from .sources.dbf import read_dbf, write_dbf
    t = T(spark, d)
    folder = scratch_path(spark, "dbf")
    write_dbf(t.raw_site, folder, "site", prefix="123a")
    write_dbf(t.raw_water, folder, "water", prefix="123a")
    got = read_dbf(spark, folder, family="site")
    return got.select(*[F.col(f.name).cast(f.dataType) for f in t.raw_site.schema.fields])


register("src_dbf_scan", W("raw_site") + "SELECT * FROM raw_site")(_q_dbf)


def _q_stream(spark, d):
    from .streaming.batch_stream import load_stream
    t = T(spark, d)
    src = _site_cols(t)
    landing = scratch_path(spark, "landing")
    # two proofed deliveries land; one availableNow run loads both
    src.filter(F.col("pass") == 1).write.parquet(landing + "/delivery=1")
    src.filter(F.col("pass") != 1).write.parquet(landing + "/delivery=2")
    root = scratch_path(spark, "store")
    rules = {"site": {"pk": ["site_id"], "not_null": ["site_id", "project_code", "year"]}}
    load_stream(spark, landing + "/delivery=*", "site", src.schema, root, scratch_path(spark, "stream-ckpt"),
                rules=rules, max_files=1)
    return files.read_store(spark, root, "site")


register("st_batch_load", W("site") + _SITE_SQL)(_q_stream)


# ------------------------------------------------------------------ oracle for ld_batch
_BATCH_TABLES = ("raw_site", "tbl_reach", "raw_fish", "raw_pittag", "raw_floytag", "raw_water")


def _batch_tables_sql() -> str:
    from .queries_etl import FISH_ETL_SQL, _TS
    return FISH_ETL_SQL + f"""
, pr AS (SELECT key_aaa, key_aa, key_a, nullif(pit_type, 'Z') AS pit_type, nullif(pit_num, 'Z') AS pit_num,
    nullif(pit_recap, 'Z') AS pit_recap, nullif(pit_notes, 'Z') AS pit_notes FROM raw_pittag WHERE pit_num IS NOT NULL)
, pittag_b AS (SELECT pr.key_aaa AS pit_id, pr.key_aa AS fish_id, CAST(pr.pit_type AS VARCHAR) AS pit_type,
    upper(pr.pit_num) AS pit_num, pr.pit_recap, pr.pit_notes FROM pr)
, fl AS (SELECT key_aab, key_aa, nullif(floy_color, 'Z') AS floy_color, nullif(floy_num, 'Z') AS floy_num,
    nullif(floy_recap, 'Z') AS floy_recap, nullif(floy_notes, 'Z') AS floy_notes FROM raw_floytag WHERE floy_num IS NOT NULL)
, floytag_b AS (SELECT key_aab AS floy_id, key_aa AS fish_id, floy_color, floy_num, floy_recap, floy_notes FROM fl)
, water_qual_b AS (SELECT w.key_ab AS water_id, k.site_id, nullif(w.secchi, 0) AS secchi FROM raw_water w
    LEFT JOIN km k ON w.key_a IS NOT DISTINCT FROM k.key_a)
, site_b AS (SELECT site_id, project AS project_code, year, river, reach, pass, startdatetime, enddatetime, start_rmi,
    end_rmi, shoreline, el_sec, boat, crew, site_notes, 1 AS upload_id FROM se)
, fish_b AS (SELECT fish_id, site_id, rmi, datetime, species, tot_length, weight, sex, rep_cond, tubercles, ray_ct, disp,
    fish_notes, loc_x, loc_y, epsg FROM fe)
, meta_b AS (SELECT DISTINCT lower(nullif(project, 'Z')) AS project_code,
    CAST(year(try_strptime(nullif(date, 'Z') || ' ' || nullif(starttime, 'Z'), {_TS})) AS INTEGER) AS year,
    'Pat' AS principal_fname, 'Doe' AS principal_lname, 'UDWR-M' AS agency, 'EL' AS data_type FROM raw_site)"""


def _ld_batch_sql() -> str:
    tables_sql = _batch_tables_sql()
    cols = {
        "meta": ["project_code", "year", "principal_fname", "principal_lname", "agency", "data_type"],
        "site": ["site_id", "project_code", "year", "river", "reach", "pass", "startdatetime", "enddatetime",
                 "start_rmi", "end_rmi", "shoreline", "el_sec", "boat", "crew", "site_notes", "upload_id"],
        "water_qual": ["water_id", "site_id"],
        "fish": ["fish_id", "site_id", "rmi", "datetime", "species", "tot_length", "weight", "sex", "rep_cond",
                 "tubercles", "ray_ct", "disp", "fish_notes", "loc_x", "loc_y", "epsg"],
        "pittag": ["pit_id", "fish_id", "pit_type", "pit_num", "pit_recap", "pit_notes"],
        "floytag": ["floy_id", "fish_id", "floy_color", "floy_num", "floy_recap", "floy_notes"],
    }
    parts = []

    def key(cs):
        return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NA')" for c in cs)

    for table, rule in ck.STORE_RULES.items():
        if table not in cols:
            continue
        have = cols[table]
        src = f"{table}_b"
        uniq = ([("primary_key", rule["pk"])] if rule.get("pk") else []) + [("unique", u) for u in rule.get("unique", [])]
        for name, cs in uniq:
            if not all(c in have for c in cs):
                continue
            nn = " AND ".join(f"{c} IS NOT NULL" for c in cs)
            parts.append(f"SELECT {_v(table, name, ','.join(cs), key(cs), 'count(*)')} FROM {src} WHERE {nn} "
                         f"GROUP BY {', '.join(cs)} HAVING count(*) > 1")
        for c in rule.get("not_null", []):
            if c in have:
                parts.append(f"SELECT {_v(table, 'not_null', c, 'CAST(NULL AS VARCHAR)', 'count(*)')} FROM {src} "
                             f"WHERE {c} IS NULL HAVING count(*) > 0")
        for c, values in rule.get("domain", {}).items():
            if c in have:
                sev = "warn" if None in values else "error"
                lst = ", ".join(f"'{v}'" for v in values if v is not None)
                parts.append(f"SELECT {_v(table, 'domain', c, f'CAST({c} AS VARCHAR)', 'count(*)', sev)} FROM {src} "
                             f"WHERE {c} IS NOT NULL AND {c} NOT IN ({lst}) GROUP BY {c}")
        for c in rule.get("nonzero", []):
            if c in have:
                parts.append(f"SELECT {_v(table, 'nonzero', c, 'CAST(NULL AS VARCHAR)', 'count(*)')} FROM {src} "
                             f"WHERE {c} = 0 HAVING count(*) > 0")
        for cs, ptable, pcs in rule.get("fk", []):
            if ptable not in cols or not all(c in have for c in cs):
                continue
            nn = " AND ".join(f"c.{c} IS NOT NULL" for c in cs)
            match = " AND ".join(f"p.{pc} = c.{c}" for c, pc in zip(cs, pcs))
            parts.append(f"SELECT {_v(table, 'foreign_key', ','.join(cs), key(['c.' + c for c in cs]), 'count(*)')} "
                         f"FROM {src} c WHERE {nn} AND NOT EXISTS (SELECT 1 FROM {ptable}_b p WHERE {match}) "
                         f"GROUP BY {', '.join('c.' + c for c in cs)}")
    return (W(*_BATCH_TABLES) + tables_sql
            + "\nSELECT * FROM (" + "\nUNION ALL ".join(parts) + ") v")


register("ld_batch", _ld_batch_sql())(_q_batch)


def _ld_batch_loaded_sql() -> str:
    """Rows of each table that break no rule and whose parents are loaded, rules written out."""
    lists = {(t, c): ", ".join(f"'{x}'" for x in v.split()) for t, c, v in _LISTS}
    listed = lambda t, c: f"({c} IS NULL OR {c} IN ({lists[t, c]}))"
    whole = lambda t, skip="": " AND ".join(f"{c} IS NOT NULL" for c in _NN[t].split() if c not in skip.split())
    return W(*_BATCH_TABLES) + _batch_tables_sql() + f"""
, meta_n AS (SELECT *, row_number() OVER (ORDER BY year NULLS LAST, project_code NULLS LAST) AS meta_id FROM meta_b)
, meta_c AS (SELECT * FROM meta_n WHERE {whole("meta")} QUALIFY row_number() OVER (PARTITION BY year ORDER BY project_code) = 1)
, site_c AS (SELECT * FROM site_b WHERE {whole("site")} AND {listed("site", "river")} AND {listed("site", "reach")}
    AND {listed("site", "shoreline")} AND el_sec <> 0 AND (project_code, year) IN (SELECT (project_code, year) FROM meta_c))
, water_c AS (SELECT * FROM water_qual_b WHERE {whole("water_qual")} AND site_id IN (SELECT site_id FROM site_c))
, fish_c AS (SELECT * FROM fish_b WHERE {whole("fish")} AND {listed("fish", "species")} AND {listed("fish", "disp")}
    AND coalesce(tot_length, 1) <> 0 AND coalesce(weight, 1) <> 0 AND coalesce(loc_x, 1) <> 0 AND coalesce(loc_y, 1) <> 0
    AND site_id IN (SELECT site_id FROM site_c))
, pit_c AS (SELECT * FROM pittag_b WHERE {whole("pittag")} AND {listed("pittag", "pit_recap")} AND {listed("pittag", "pit_type")}
    AND fish_id IN (SELECT fish_id FROM fish_c))
, floy_c AS (SELECT * FROM floytag_b WHERE {whole("floytag")} AND {listed("floytag", "floy_recap")} AND {listed("floytag", "floy_color")}
    AND fish_id IN (SELECT fish_id FROM fish_c))
""" + "\nUNION ALL ".join(f"SELECT DISTINCT '{n}' AS tbl, CAST({k} AS VARCHAR) AS key, CAST({p} AS VARCHAR) AS parent, CAST({w} AS VARCHAR) AS what FROM {src}"
                         for (n, (k, p, w)), src in zip(_READ_BACK.items(), ("meta_c", "site_c", "water_c", "fish_c", "pit_c", "floy_c")))


register("ld_batch_proofed", _ld_batch_loaded_sql())(_q_batch_loaded)
