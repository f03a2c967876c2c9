"""Integrity rules as a validation job: primary/unique keys, NOT NULL, domains,
non-zero measures and foreign keys, checked before a batch is appended.

Parquet tables carry no constraints, so each rule is a query that returns violation
rows ``(table, rule, column, key, n)``: ``column`` names the checked column(s), ``key``
the offending value (text, "NA" for NULL parts) and ``n`` how many batch rows carry it.
Every check is an aggregate or a semi/anti join on the key -- never a scan of all pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VIOLATION_COLS = ["table", "rule", "column", "key", "n", "severity"]

# Column value lists of the store tables (CHECK ... IN lists).
AGENCIES = ["UDWR-M", "UDWR-V", "CSU", "FWS-GJ", "FWS-V"]
DATA_TYPES = ["EL", "SE", "TR", "ANT", "OT"]
RIVERS = ["CO", "GR", "SJ", "LP", "DO", "PR", "SR", "OT"]
REACHES = ["LGR", "LCO", "WW", "DESO", "LDO", "MGR", "ECHO", "MATH", "USJ", "MSJ", "LSJ", "LPCO", "LPSJ",
           "LSR", "LPR", "OT"]
SHORELINES = ["R", "L", "B", "OT", "UNK"]
SPECIES = ["BB", "BC", "BCT", "BEAV", "BFL", "BFW", "BG", "BGGS", "BH", "BHLS", "BHRZ", "BHWS", "BK", "BLW",
           "BM", "BN", "BR", "BS", "BT", "BU", "CC", "CH", "CHBT", "CHHB", "CHRT", "CP", "CR", "CRCT", "CS",
           "CT", "FB", "FH", "FM", "FMLS", "FR", "GA", "GC", "GD", "GS", "GZ", "HB", "ID", "IN", "KO", "KOI",
           "LD", "LG", "LK", "LM", "LS", "LSWS", "MF", "MS", "MT", "NP", "PK", "RB", "RC", "RD", "RH", "RS",
           "RT", "RTBT", "RZ", "RZWS", "SB", "SD", "SM", "SP", "SS", "SU", "TM", "TS", "UC", "UI", "UM", "WB",
           "WC", "WE", "WF", "WS", "YB", "YP"]
SEXES = ["F", "M", "I", None]
REP_CONDS = ["EXP_EGG", "EXP_MILT", "INT_EGG", "INT_MILT", "SPENT", "NOT", None]
TUBERCLES = ["Y", "N", None]
DISPOSITIONS = ["CT", "DE", "RT", "FC", "HA", "DF", "SS", "DP", "RA", "TR", "TL", "UNK", "OT"]
PIT_RECAPS = ["Y", "N", "NNF", "UNK"]
PIT_TYPES = ["134", "400"]
FLOY_RECAPS = ["Y", "N", "UNK"]
FLOY_COLORS = ["PUR", "BRN", "WHT", "RED", "YEL", "GRN", "OR", "GRY", "CL", "OT"]
VIAL_TYPES = ["LF", "UIF", "FIN", "RAY", "SCA", "EYE", "BLD", "STO", "GUT", "OTO", "MUS", "OT"]

# The store schema as rules: primary key, NOT NULL columns, value lists, non-zero
# columns and foreign keys (child columns -> parent table and columns).
STORE_RULES = {
    "meta": {"pk": ["meta_id"], "unique": [["year"], ["project_code", "year"]],
             "not_null": ["meta_id", "project_code", "year", "principal_fname", "principal_lname", "agency",
                          "data_type"],
             "domain": {"agency": AGENCIES, "data_type": DATA_TYPES}},
    "site": {"pk": ["site_id"],
             "not_null": ["site_id", "project_code", "year", "river", "reach", "start_rmi", "end_rmi",
                          "startdatetime", "enddatetime", "shoreline", "el_sec", "upload_id"],
             "domain": {"river": RIVERS, "reach": REACHES, "shoreline": SHORELINES},
             "nonzero": ["el_sec"], "fk": [(["project_code", "year"], "meta", ["project_code", "year"])]},
    "water_qual": {"pk": ["water_id"], "not_null": ["water_id", "site_id"],
                   "fk": [(["site_id"], "site", ["site_id"])]},
    "fish": {"pk": ["fish_id"], "not_null": ["fish_id", "site_id", "rmi", "species", "disp"],
             "domain": {"species": SPECIES, "sex": SEXES, "rep_cond": REP_CONDS, "tubercles": TUBERCLES,
                        "disp": DISPOSITIONS},
             "nonzero": ["tot_length", "weight", "loc_x", "loc_y"],
             "fk": [(["site_id"], "site", ["site_id"])]},
    "pittag": {"pk": ["pit_id"], "not_null": ["pit_id", "fish_id", "pit_recap", "pit_num", "pit_type"],
               "domain": {"pit_recap": PIT_RECAPS, "pit_type": PIT_TYPES},
               "fk": [(["fish_id"], "fish", ["fish_id"])]},
    "floytag": {"pk": ["floy_id"], "not_null": ["floy_id", "fish_id", "floy_num", "floy_recap"],
                "domain": {"floy_recap": FLOY_RECAPS, "floy_color": FLOY_COLORS},
                "fk": [(["fish_id"], "fish", ["fish_id"])]},
    "vial": {"pk": ["vial_id"], "not_null": ["vial_id", "fish_id", "vial_type"],
             "domain": {"vial_type": VIAL_TYPES}, "fk": [(["fish_id"], "fish", ["fish_id"])]},
}

# Column types of the store tables (the DDL as Spark schemas).
STORE_SCHEMAS = {
    "meta": "meta_id int, project_code string, year int, principal_fname string, principal_lname string, "
            "agency string, data_type string",
    "site": "site_id string, project_code string, year int, river string, reach string, pass int, "
            "start_rmi double, end_rmi double, startdatetime timestamp_ntz, enddatetime timestamp_ntz, "
            "shoreline string, el_sec int, boat string, crew string, site_notes string, upload_id int",
    "water_qual": "water_id string, site_id string, cond_amb int, cond_spec int, rvr_temp decimal(4,1), "
                  "secchi int, water_notes string",
    "fish": "fish_id string, site_id string, datetime timestamp_ntz, rmi double, species string, tot_length int, "
            "weight int, sex string, rep_cond string, tubercles string, ray_ct string, disp string, loc_x double, "
            "loc_y double, epsg int, fish_notes string",
    "pittag": "pit_id string, fish_id string, pit_recap string, pit_num string, pit_type string, pit_notes string",
    "floytag": "floy_id string, fish_id string, floy_num string, floy_recap string, floy_color string, "
               "floy_ref int, floy_notes string",
    "vial": "vial_id string, fish_id string, vial_num string, vial_type string, vial_notes string",
}


def store_schema(spark, table: str):
    """The store table's ``StructType``."""
    return spark.createDataFrame([], STORE_SCHEMAS[table]).schema


def conform(df: DataFrame, table: str) -> DataFrame:
    """The store table's columns in order and type; absent columns are NULL, others dropped."""
    schema = store_schema(df.sparkSession, table)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


# Append order that keeps every parent ahead of its children.
LOAD_ORDER = ["meta", "site", "water_qual", "fish", "pittag", "floytag", "vial"]


def _key_text(cols) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols])


def _rows(df: DataFrame, table: str, rule: str, column: str, key: Column, n: Column,
          severity: str = "error") -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(column).alias("column"),
                     key.cast("string").alias("key"), n.cast("long").alias("n"), F.lit(severity).alias("severity"))


def empty_violations(spark) -> DataFrame:
    return spark.createDataFrame([], "table string, rule string, column string, key string, n long, severity string")


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def check_unique(df: DataFrame, table: str, cols, store: DataFrame | None = None,
                 rule: str = "unique") -> DataFrame:
    """Keys repeated inside the batch, and batch keys already present in the store.

    Rows with a NULL key part are not compared (SQL UNIQUE semantics). The batch side is
    a grouped count (partial aggregation first); the store side is a semi-join of the
    batch's distinct keys, so the store is never scanned pairwise.
    """
    cols = list(cols)
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    counts = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    dup = _rows(counts.filter(F.col("_n") > 1), table, rule, ",".join(cols), _key_text(cols), F.col("_n"))
    if store is None:
        return dup
    existing = counts.join(store.select(*cols).distinct(), cols, "left_semi")
    return dup.unionByName(_rows(existing, table, f"{rule}_store", ",".join(cols), _key_text(cols), F.col("_n")))


def _lists_null(values) -> bool:
    return any(v is None for v in values)


def check_rules(df: DataFrame, table: str, not_null=(), domain: dict | None = None, nonzero=(),
                severity: str | None = None) -> DataFrame:
    """All NOT NULL, value-list and non-zero rules of a table in one scan.

    Each row lists the rules it breaks; (rule, column, value) counts are one aggregate over
    those, combined map-side. An absent NOT NULL column is broken by every row, other absent
    columns are not checked. A value list that holds NULL can never fail in SQL (``x IN (..,
    NULL)`` is NULL, and a CHECK passes on NULL): its findings have severity "warn".
    """
    have = set(df.columns)

    def broken(cond: Column, rule: str, col: str, key: Column, sev: str = "error") -> Column:
        return F.when(cond, F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column"),
                                     key.cast("string").alias("key"), F.lit(sev).alias("severity")))

    none = F.lit(None)
    hits = [broken(F.col(c).isNull() if c in have else F.lit(True), "not_null", c, none) for c in not_null]
    for c, values in (domain or {}).items():
        if c in have:
            listed = [v for v in values if v is not None]
            sev = severity or ("warn" if _lists_null(values) else "error")
            hits.append(broken(F.col(c).isNotNull() & ~F.col(c).isin(listed), "domain", c, F.col(c), sev))
    hits += [broken(F.col(c) == 0, "nonzero", c, none) for c in nonzero if c in have]
    if not hits:
        return empty_violations(df.sparkSession)
    rows = df.select(F.explode(F.array_compact(F.array(*hits))).alias("v"))
    counts = rows.groupBy("v.rule", "v.column", "v.key", "v.severity").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.lit(table).alias("table"), "rule", "column", "key", "n", "severity")


def check_not_null(df: DataFrame, table: str, cols) -> DataFrame:
    """NULL counts of the listed columns; an absent column is NULL in every row."""
    return check_rules(df, table, not_null=cols)


def check_domain(df: DataFrame, table: str, col: str, values, severity: str | None = None) -> DataFrame:
    """Values outside the list, counted per value. NULL passes."""
    return check_rules(df, table, domain={col: values}, severity=severity)


def check_nonzero(df: DataFrame, table: str, cols) -> DataFrame:
    """Zero counts of the listed measure columns."""
    return check_rules(df, table, nonzero=cols)


def check_foreign_key(child: DataFrame, parent: DataFrame | None, cols, parent_cols=None,
                      table: str = "child") -> DataFrame:
    """Child keys with no parent row, counted per key. A NULL key part passes.

    Without a parent table every child key is a violation.

    Child keys are reduced to distinct (key, count) first, then anti-joined with the
    parent's keys.
    """
    cols = list(cols)
    pcols = list(parent_cols or cols)
    keyed = child.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    counts = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    missing = counts
    if parent is not None:
        p = parent.select(*[F.col(pc).alias(c) for c, pc in zip(cols, pcols)]).distinct()
        missing = counts.join(p, cols, "left_anti")
    return _rows(missing, table, "foreign_key", ",".join(cols), _key_text(cols), F.col("_n"))


def validate_table(spark, table: str, df: DataFrame, store: dict | None = None,
                   parents: dict | None = None, rules: dict | None = None) -> DataFrame:
    """All rules of one store table for a batch ``df``.

    ``store``: existing store tables by name (for key clashes and parents);
    ``parents``: batch tables by name, also valid parents for foreign keys.
    """
    r = (rules or STORE_RULES)[table]
    store = store or {}
    parents = parents or {}
    out = []
    if r.get("pk") and all(c in df.columns for c in r["pk"]):
        out.append(check_unique(df, table, r["pk"], store.get(table), rule="primary_key"))
    for u in r.get("unique", []):
        if all(c in df.columns for c in u):
            out.append(check_unique(df, table, u, store.get(table)))
    if any(r.get(k) for k in ("not_null", "domain", "nonzero")):
        out.append(check_rules(df, table, r.get("not_null", ()), r.get("domain"), r.get("nonzero", ())))
    for cols, ptable, pcols in r.get("fk", []):
        if not all(c in df.columns for c in cols):
            continue
        sources = [t.select(*pcols) for t in (parents.get(ptable), store.get(ptable)) if t is not None]
        out.append(check_foreign_key(df, union_all(sources) if sources else None, cols, pcols, table))
    return union_all(out) if out else empty_violations(spark)


def split_rows(df: DataFrame, table: str, parents: dict | None = None, rules: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule of the table, the others): the mechanical part of proofing.

    Of rows with one key the first in the order of all columns stays. ``parents``: the tables
    that foreign keys are held against, already split, so that a child of a rejected parent
    is rejected, too.
    """
    r, have = (rules or STORE_RULES)[table], set(df.columns)
    bad = reduce(lambda a, b: a | b, [
        F.lit(False), *[F.col(c).isNull() if c in have else F.lit(True) for c in r.get("not_null", [])],
        *[F.coalesce(~F.col(c).isin([v for v in values if v is not None]), F.lit(False))
          for c, values in r.get("domain", {}).items() if c in have and not _lists_null(values)],
        *[F.coalesce(F.col(c) == 0, F.lit(False)) for c in r.get("nonzero", []) if c in have]])
    d = df.withColumn("_bad", bad)
    for cols, ptable, pcols in r.get("fk", []):
        if all(c in have for c in cols) and (parents or {}).get(ptable) is not None:
            p = parents[ptable].select(*[F.col(pc).alias(f"_p{k}") for k, pc in enumerate(pcols)], F.lit(True).alias("_has")).distinct()
            d = d.join(p, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{k}") for k, c in enumerate(cols)]), "left")
            absent = F.col("_has").isNull() & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
            d = d.withColumn("_bad", F.col("_bad") | absent).drop("_has", *[f"_p{k}" for k in range(len(cols))])
    keys = [k for k in [r.get("pk"), *r.get("unique", [])] if k and all(c in have for c in k)]
    for n, key in enumerate(keys):
        # the rows of a key meet once, in order; rows without a key are not compared, only their copies found
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        own = Window.partitionBy(*key, "_own").orderBy("_bad", *df.columns)
        d = d.withColumn("_own", F.when(~known, F.xxhash64(*df.columns)))
        if n == 0:
            # rows alike in all columns have one rank
            d = d.withColumns({"_rank": F.rank().over(own), "_copy": F.row_number().over(own) > F.rank().over(own)})
        else:
            d = d.withColumn("_rank", F.rank().over(own))
        d = d.withColumn("_bad", F.col("_bad") | (known & (F.col("_rank") > 1))).drop("_own", "_rank")
    clean = d.filter(~F.col("_bad") & ~F.col("_copy")) if keys else d.filter(~F.col("_bad"))
    return clean.select(*df.columns), d.filter("_bad").select(*df.columns)
