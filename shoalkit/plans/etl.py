"""ETL: raw capture tables -> keyed, cleaned site/water/fish/tag/vial tables.

Shape at scale: each raw family is one lazy union; the site key map is derived once
and joined (by ``key_a``) into every child table -- NULL-safely, as the local frames
of the reference matched NA to NA; the row indexes use ``dealt_index`` (sampled ranges +
per-range offsets, never one task). A whole fish row moves twice, its texts packed into one
column: to its site's key, where the key map is joined and the mean point of each (site, mile)
is taken, and to its range of the index; between the moves it is written, so that the files
of the first are gone before the second. Fish without a site, whose points span keys, get
theirs by a join of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EPSG_UTM12N, utm_xy
from ..operators.aggregate import mean_point
from ..operators.clean import (change_case, date_time, keep_if_in, mdy, mdy_time, mile_correction,
                               sentinel_to_null, value_to_null, zero_to_null)
from ..operators.joins import keyed_join, lookup
from ..operators.keys import build_key, dealt_index
from ..operators.projection import pack_texts, unpack_texts
from ..operators.quality import NATIVE
from ..session import sealed

WATER_ZERO = ["cond_amb", "cond_spec", "rvr_temp", "secchi"]
FISH_ZERO = ["ilat", "ilon", "tot_length", "st_length", "weight"]


#: The columns of the site table that ``key_map`` takes.
KEY_COLUMNS = ["key_a", "site_id", "startdatetime", "reach"]


def _rmi_corrected(df: DataFrame, reach: str = "reach") -> DataFrame:
    cols = [c for c in df.columns if c.endswith("rmi")]
    return df.withColumns({c: mile_correction(F.col(c), F.col(reach)) for c in cols})


SITE_COLUMNS = ["s_index", "site_id", "project", "year", "river", "reach", "pass", "startdatetime", "enddatetime", "start_rmi", "end_rmi",
                "shoreline", "el_sec", "boat", "crew", "site_notes", "key_a"]


def build_site(raw: DataFrame, reach_dim: DataFrame, start_num: int = 1, columns=SITE_COLUMNS) -> DataFrame:
    """Clean, time-stamp, number and key the site rows.

    s_index orders by start time (NULL last) with ``key_a`` as the explicit tie-break;
    site_id = project_year_NNN with NNN = s_index + start_num - 1 (never truncated).
    ``columns``: those that are wanted; others are not moved.
    """
    s = sentinel_to_null(raw)
    s = s.withColumn("_date", mdy(F.col("date"))).select(
                 *s.columns,
                 date_time(F.col("_date"), F.col("starttime")).alias("startdatetime"),
                 date_time(F.col("_date"), F.col("endtime")).alias("enddatetime"),
                 (F.col("effort_sec") + F.col("effort_min") * 60).alias("el_sec"))
    s = s.withColumn("project", F.lower("project")).withColumn("year", F.year("startdatetime"))
    order = ["startdatetime", "key_a"]
    # rows that share a key are told apart by all their columns, wanted or not
    rest = F.xxhash64(*[c for c in s.columns if c not in order])
    s = s.select(*[c for c in s.columns if c in {"project", "reach", *order, *columns}], rest.alias("_h"))
    s = dealt_index(s, order, "s_index", ties=["_h"], rest=[])
    s = s.withColumn("site_id", build_key([F.col("project"), F.year("startdatetime")],
                                          F.col("s_index") + F.lit(start_num - 1)))
    s = lookup(s, reach_dim.select("rch_code", "rvr_code"), {"reach": "rch_code"}).withColumnRenamed("rvr_code", "river")
    return _rmi_corrected(s.select(*columns))


def key_map(site: DataFrame) -> DataFrame:
    """key_a -> site_id, site time and reach, put on every child table."""
    return site.select("key_a", "site_id", F.col("startdatetime").alias("t_stamp"), "reach")


def build_water(raw: DataFrame, samp_n: DataFrame) -> DataFrame:
    w = sentinel_to_null(zero_to_null(raw, WATER_ZERO))
    w = keyed_join(w, samp_n, {"key_a": "key_a"}, "left", null_safe=True)
    # rows come out unordered; the sink sorts by site time if a file needs it
    return w.select(F.col("key_ab").alias("water_id"), "site_id", "cond_amb", "cond_spec", "rvr_temp",
                    "secchi", F.col("h2o_notes").alias("water_notes"), "key_a")


def clean_fish(raw: DataFrame, native=NATIVE) -> DataFrame:
    f = sentinel_to_null(zero_to_null(raw, FISH_ZERO))
    f = value_to_null(f, {"ray_ct": "N"})
    f = keep_if_in(f, "tubercles", "species", native)
    return change_case(f, upper=["rep_cond"])


def fish_times(raw: DataFrame, samp_n: DataFrame) -> DataFrame:
    """fish_id, datetime and species of every fish: all that tags take from the fish."""
    f = sentinel_to_null(raw.select("key_aa", "key_a", "time", "species"))
    f = keyed_join(f, samp_n.select("key_a", "t_stamp"), {"key_a": "key_a"}, "left", null_safe=True)
    return f.select(F.col("key_aa").alias("fish_id"), date_time(F.to_date("t_stamp"), F.col("time")).alias("datetime"), "species")


def _lost_points(f: DataFrame) -> DataFrame:
    """``ilon`` and ``ilat`` of fish without a site replaced by the mean point of their mile.

    A group a mile, NULL matching NULL as in the local R join, whatever the fish's keys; fish
    with a site have their points already.
    """
    there, lost = f.filter(F.col("site_id").isNotNull()), f.filter(F.col("site_id").isNull())
    pts = mean_point(lost.select("_mile", "ilon", "ilat"), ["_mile"], "ilon", "ilat")
    return there.unionByName(keyed_join(lost.drop("ilon", "ilat"), pts, {"_mile": "_mile"}, "left", null_safe=True))


def build_fish(raw: DataFrame, samp_n: DataFrame, native=NATIVE) -> DataFrame:
    """Fish with site keys, datetime, index, corrected mile and the UTM mean point per (site, mile)."""
    kind = samp_n.schema["key_a"].dataType
    parts = {"_k": F.coalesce(F.col("key_a").cast(kind), F.lit("0").cast(kind)), "_kn": F.col("key_a").isNull()}
    f, keys = clean_fish(raw, native), samp_n.withColumns(parts).drop("key_a")
    cols = [*f.columns, *[c for c in samp_n.columns if c != "key_a"], "datetime"]
    texts = [c for c, t in f.dtypes if t == "string"]
    f = f.withColumns(parts).select("*", pack_texts(texts).alias("_texts")).drop(*texts).join(keys, ["_k", "_kn"], "left")
    f = f.withColumns(unpack_texts("_texts", texts))
    f = f.withColumn("datetime", date_time(F.to_date("t_stamp"), F.col("time")))
    order, ties = ["datetime", "key_aa"], ["tot_length", "weight", "st_length", "_h"]
    # rows that share a key are told apart by their captured columns, not by the point of their group
    f = f.select(*cols, "_k", "_kn", mile_correction(F.col("rmi"), F.col("reach")).alias("_mile"), F.xxhash64(*[c for c in cols if c not in order]).alias("_h"))
    # a site id has one key: the mean of its points is taken where its fish are
    own, seen = Window.partitionBy("_k", "_kn", "site_id", "_mile"), F.col("site_id").isNotNull()
    f = f.withColumns({c: F.when(seen, F.avg(c).over(own)).otherwise(F.col(c)) for c in ("ilon", "ilat")})
    f = f.select(*order, *ties, "site_id", "reach", "_mile", "species", "sex", "rep_cond", "tubercles", "ray_ct", "disp", "fish_notes", "key_a", "ilon", "ilat")
    f = dealt_index(f, order, "f_index", ties=ties, rest=[], add=_lost_points,
                    sample=fish_times(raw, samp_n).select("datetime", F.col("fish_id").alias("key_aa")))
    x, y = utm_xy("ilon", "ilat")  # NULL without a point; outside a condition, its common terms are taken once
    return f.select("f_index", F.col("key_aa").alias("fish_id"), "site_id", "reach", F.col("_mile").alias("rmi"), "datetime", "species",
                    "tot_length", "weight", "sex", "rep_cond", "tubercles", "ray_ct", "disp", "fish_notes", "key_a",
                    x.alias("loc_x"), y.alias("loc_y"), F.when(F.col("ilon").isNotNull(), F.lit(EPSG_UTM12N)).alias("epsg"))


def build_tags(raw: DataFrame, samp_n: DataFrame, fish: DataFrame, kind: str = "pit") -> DataFrame:
    """PIT or Floy tags with site key, fish species and time, index and upper-case number.

    Rows without a tag number are dropped *before* the sentinel pass, so a "Z" number
    survives as NULL.
    """
    num = "pit_num" if kind == "pit" else "floy_num"
    t = raw.filter(F.col(num).isNotNull())
    t = sentinel_to_null(t)
    if kind != "pit":
        t = t.drop("floy_id")
    t = keyed_join(t, samp_n.select("key_a", "site_id"), {"key_a": "key_a"}, "left", null_safe=True)
    idk = "key_aaa" if kind == "pit" else "key_aab"
    t = t.withColumnRenamed(idk, f"{kind}_id").withColumnRenamed("key_aa", "fish_id")
    t = keyed_join(t, fish.select("fish_id", "datetime", "species"), {"fish_id": "fish_id"}, "left", null_safe=True)
    idx = "p_index" if kind == "pit" else "fl_index"
    # the index is numbered after a count: the joins run once
    t = dealt_index(sealed(t, f"{kind}-tags"), ["datetime", f"{kind}_id"], idx, at_rest=True)
    if kind == "pit":
        t = t.withColumn("pit_num", F.upper("pit_num"))
        return t.select(idx, "pit_id", "fish_id", "site_id", "species", "pit_type", "pit_num", "pit_recap",
                        "pit_notes", "key_a")
    return t.select(idx, "floy_id", "fish_id", "site_id", "species", "floy_color", "floy_num", "floy_recap",
                    "floy_notes")


def build_vial(raw: DataFrame) -> DataFrame:
    """Vial rows stacked, "Z" -> NULL, passed through without key or rule."""
    return sentinel_to_null(raw)


def meta_rows(raw_site: DataFrame, principal_fname: str, principal_lname: str, agency: str,
              data_type: str) -> DataFrame:
    """One meta row per (project, year) of the batch, with the configured people and codes."""
    s = sentinel_to_null(raw_site).select(
        F.lower("project").alias("project_code"),
        F.year(mdy_time(F.col("date"), F.col("starttime"))).alias("year")).distinct()
    return s.select("project_code", "year", F.lit(principal_fname).alias("principal_fname"),
                    F.lit(principal_lname).alias("principal_lname"), F.lit(agency).alias("agency"),
                    F.lit(data_type).alias("data_type"))



def meta_row(spark, project_code: str, year: int, principal_fname: str, principal_lname: str,
             agency: str, data_type: str) -> DataFrame:
    """The one configured meta row of a batch (when the batch is not read from captures)."""
    return spark.createDataFrame(
        [(project_code, int(year), principal_fname, principal_lname, agency, data_type)],
        "project_code string, year int, principal_fname string, principal_lname string, agency string, "
        "data_type string")
