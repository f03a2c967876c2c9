"""Quality rules as data: each rule is (flag column, Column expression).

Flags hold "FLAG", "" or NULL with the reference's three-valued semantics (N1-N3).
A table function applies its rule list with one ``withColumns`` (a single projection,
whole-stage codegen, no shuffle); only the orphan/zero-catch rules need the join with
the parent table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixtures import REACH_BOUNDS_ROWS
from ..functions.nulls import FLAG, any_flag, any_null, case_flag, flag, in_set, not_in_set
from .clean import seconds_between
from .joins import natural_join
from .projection import column_range

# The quality rules' species lists.
NATIVE = ["CS", "RZ", "HB", "BT", "FM", "BH", "RT", "SD", "CH"]
COMMON_SPECIES = ["CS", "RZ", "HB", "BT", "SD", "FM", "BH", "RT", "SM", "BC",
                  "LG", "BG", "GS", "GC", "BB", "YB", "WE", "GZ", "NP", "WS", "CH"]
LARGE_SPECIES = ["CC", "GC", "NP"]
MAX_LENGTH = 1000
MAX_WEIGHT = 2800
EL_SEC_MIN, EL_SEC_MAX = 1000, 7200
MAX_RMI_LENGTH = 5
PIT_LENGTHS = {"134": 14, "400": 9}


def apply_rules(df: DataFrame, rules) -> DataFrame:
    return df.withColumns(dict(rules))


def flagged_only(df: DataFrame, suffix: str = "flg") -> DataFrame:
    """Rows where any ``*<suffix>`` column is "FLAG" (NULL is not a flag)."""
    cols = [c for c in df.columns if c.endswith(suffix)]
    return df.filter(any_flag(cols))


def _in_reach(reach: Column, miles, bounds) -> Column:
    """TRUE when every mile lies inside its reach's inclusive bounds; NULL-free."""
    conds = []
    for code, lo, hi in bounds:
        c = reach == code
        for m in miles:
            c = c & m.between(F.lit(float(lo)), F.lit(float(hi)))
        conds.append(F.coalesce(c, F.lit(False)))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def site_rules(df: DataFrame, bounds=REACH_BOUNDS_ROWS, na_from: str = "s_index", na_to: str = "crew",
               start: str = "startdatetime", end: str = "enddatetime", version: int = 2):
    s, e = F.col("start_rmi"), F.col("end_rmi")
    secs = seconds_between(F.col(start), F.col(end))
    el = F.col("el_sec")
    rules = []
    if version == 2:
        rules.append(("rmi_length_flg", flag(((s - e) > MAX_RMI_LENGTH) | (s < e))))
        rules.append(("rmi_flg", F.when(_in_reach(F.col("reach"), [s, e], bounds), F.lit("")).otherwise(F.lit(FLAG))))
    else:
        rules.append(("rmi_flg", flag((s - e) > MAX_RMI_LENGTH)))
    rules += [
        ("datetime_flg", flag(secs < el)),
        ("el_sec_flg", flag((el > EL_SEC_MAX) | (el < EL_SEC_MIN))),
        ("NA_flg", flag(any_null(column_range(df, na_from, na_to)))),
    ]
    return rules


def site_qc(df: DataFrame, version: int = 2, **kw) -> DataFrame:
    """Site rules: mile span, mile inside reach, duration vs effort, effort range, NULLs.

    ``version=1`` is the older rule set (first half of the span rule only) and returns
    flagged rows only.
    """
    out = apply_rules(df, site_rules(df, version=version, **kw))
    return flagged_only(out) if version == 1 else out


def fish_rules(version: int = 2, bounds=REACH_BOUNDS_ROWS):
    sp = F.col("species")
    rules = [
        ("orphan_flg", flag(F.col("s_index").isNull())),
        ("zero_catch_flg", flag(F.col("fish_id").isNull())),
    ]
    if version == 2:
        rules.append(("rmi_flg", F.when(_in_reach(F.col("reach"), [F.col("rmi")], bounds), F.lit("")).otherwise(F.lit(FLAG))))
    rules += [
        ("species_flg", flag(not_in_set(sp, COMMON_SPECIES))),
        ("tot_length_flg", flag(not_in_set(sp, LARGE_SPECIES) & (F.col("tot_length") > MAX_LENGTH))),
        ("weight_flg", flag(not_in_set(sp, LARGE_SPECIES) & (F.col("weight") > MAX_WEIGHT))),
    ]
    disp = F.col("disp")
    cond = ((disp == "DE") & in_set(sp, NATIVE)) | ((disp == "RA") & not_in_set(sp, NATIVE))
    if version == 2:
        cond = cond | disp.isNull()
    rules.append(("disp_flg", flag(cond)))
    return rules


def fish_qc(fish: DataFrame, site: DataFrame, version: int = 2) -> DataFrame:
    """Fish rules after a natural full join with the site keys (orphans, zero catch)."""
    parent = site.select("s_index", "site_id", "key_a")
    j = natural_join(parent, fish, "full", null_safe=True)
    out = apply_rules(j, fish_rules(version))
    return flagged_only(out) if version == 1 else out


def pit_rules():
    num, recap, typ = F.col("pit_num"), F.col("pit_recap"), F.col("pit_type")
    invalid = case_flag(*[((typ.cast("string") == t) & (F.length(num) != n), FLAG)
                          for t, n in PIT_LENGTHS.items()])
    return [
        ("orphan_flg", flag(F.col("f_index").isNull())),
        ("nnf_flg", flag(recap == "NNF")),
        ("pit_recap_flg", flag((recap.isNull() & num.isNotNull()) | (num.isNull() & recap.isNotNull()))),
        ("invalid_pitnum_flg", invalid),
    ]


def pit_qc(pit: DataFrame, fish: DataFrame, version: int = 2) -> DataFrame:
    """Tag rules after a natural right join (v2) / full join (v1) with the fish keys."""
    parent = fish.select("f_index", "fish_id", "species")
    j = natural_join(parent, pit, "right" if version == 2 else "full", null_safe=True)
    out = apply_rules(j, pit_rules())
    return flagged_only(out) if version == 1 else out


def floy_qc(floy: DataFrame, na_from: str = "fl_index", na_to: str = "floy_recap") -> DataFrame:
    """Floy tag rule: any NULL across ``na_from..na_to``."""
    return floy.withColumn("NA_flg", flag(any_null(column_range(floy, na_from, na_to))))
