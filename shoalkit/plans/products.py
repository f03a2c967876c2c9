"""Data products: meta, site, fish, floy, water, tag list and map points.

Lazy compositions of scans, filters, joins and aggregates; nothing is collected.
Lookups (rivers, reaches, species, stations, meta for the chosen years) and store tables
join by key; AQE broadcasts what its measured bytes allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import case_flag, strict_mean
from ..operators.joins import lookup
from ..operators.projection import move_first
from .effort import as_of_col


def meta_product(meta: DataFrame, years) -> DataFrame:
    """Meta rows for the years of interest with ``principal`` and ``gear_type``."""
    return (meta.filter(F.col("year").isin(list(years)))
            .select("year", "project_code",
                    F.concat_ws(", ", "principal_lname", "principal_fname").alias("principal"),
                    "agency", F.col("data_type").alias("gear_type")))


def site_pointer(site: DataFrame, river: DataFrame, reach: DataFrame, water: DataFrame,
                 meta: DataFrame, years) -> DataFrame:
    """site -> river and reach names -> water quality -> meta of the chosen years (inner)."""
    s = site.withColumnRenamed("river", "rvr_code").withColumnRenamed("reach", "rch_code")
    s = lookup(s, river.select("rvr_code", "rvr_name"), {"rvr_code": "rvr_code"})
    s = lookup(s, reach.select("rch_code", "rch_name"), {"rch_code": "rch_code"})
    s = s.join(water, "site_id", "left")
    mp = meta_product(meta, years)
    s = s.join(mp, ["project_code", "year"], "inner")
    return s.drop("water_id")


def site_product(site, river, reach, water, meta, years, as_of=None) -> DataFrame:
    s = site_pointer(site, river, reach, water, meta, years).withColumn("last_modified", as_of_col(as_of))
    return move_first(s, "site_id", "project_code", "year", "rvr_name", "rch_name")


def ripe(rep_cond: str = "rep_cond"):
    """``case_when(grepl("^INT+") ~ "N", grepl("^EXP+") ~ "Y")``; other values NULL."""
    c = F.col(rep_cond)
    return case_flag((c.rlike("^INT+"), "N"), (c.rlike("^EXP+"), "Y"))


def fish_product(fish: DataFrame, site_p: DataFrame, pit: DataFrame, species: DataFrame,
                 with_site: bool = False, first: str = "fish_id", last: str = "rmi",
                 tail=None, tail_from: str = "tubercles", tail_to: str = "fish_notes") -> DataFrame:
    """Fish of the selected sites with tags, species names and ``ripe``.

    Columns: fish ``first..last``, [reach, pass,] species code and names, length,
    weight, sex, ripe, then the fish columns ``tail_from..tail_to`` (or ``tail``) and the
    tag columns. ``with_site`` adds the site's reach and pass through a left join
    instead of the semi-join (the checks script's variant).
    """
    if with_site:
        f = fish.join(site_p.select("site_id", "rch_code", "pass"), "site_id", "left")
    else:
        f = fish.join(site_p.select("site_id"), "site_id", "left_semi")
    tag_cols = [c for c in pit.columns if c not in ("fish_id", "species", "site_id")]
    tags = pit.select("fish_id", *tag_cols)
    f = f.join(tags, "fish_id", "left").withColumnRenamed("species", "spp_code")
    spp = species.select("spp_code", "com_name", "sci_name")
    f = lookup(f, spp, {"spp_code": "spp_code"}).withColumn("ripe", ripe())
    cols = fish.columns
    head = cols[cols.index(first):cols.index(last) + 1]
    if tail is None:
        tail = cols[cols.index(tail_from):cols.index(tail_to) + 1]
    shown = {"species", "tot_length", "weight", "sex", *head}
    tail = [c for c in tail if c not in shown]
    site_cols = ["rch_code", "pass"] if with_site else []
    return f.select(*head, *site_cols, "spp_code", "com_name", "sci_name", "tot_length", "weight", "sex",
                    "ripe", *tail, *tag_cols)


def floy_product(floy: DataFrame, fish: DataFrame | None = None) -> DataFrame:
    """All floy tags (not filtered by year); optionally with species, mile and reach."""
    if fish is None:
        return floy
    return floy.join(fish, "fish_id", "left")


def daily_values(daily: DataFrame, staid=None, code=None, stat=None, start=None, end=None,
                 name: str = "val") -> DataFrame:
    """Landed daily values filtered by station, parameter, statistic and date range,
    one mean value per (staid, date) named ``name``."""
    d = daily
    if staid is not None:
        d = d.filter(F.col("staid").isin(list(staid) if isinstance(staid, (list, tuple)) else [staid]))
    if code is not None:
        d = d.filter(F.col("code") == code)
    if stat is not None and "stat" not in d.columns:
        raise ValueError("daily values without a stat column cannot be filtered by statistic")
    if stat is not None:
        d = d.filter(F.col("stat") == stat)
    if start is not None:
        d = d.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        d = d.filter(F.col("date") <= F.lit(end).cast("date"))
    return d.groupBy("staid", "date").agg(F.avg("val").alias(name))


def water_product(daily: DataFrame, stations: DataFrame, year: int, discharge_code: str = "00060",
                  temp_code: str = "00010", as_of=None) -> DataFrame:
    """Daily discharge full-joined with temperature per station, stations stacked.

    The full outer join on (staid, date) is written as one conditional aggregation:
    a (staid, date) row exists when either parameter has a value there, and each
    parameter is the mean of its rows (NULL when absent). One shuffle, no join.
    Per-station temperature statistic applies where the data carries a ``stat`` column.
    """
    st = stations
    d = daily.filter(F.col("code").isin(discharge_code, temp_code)
                     & (F.col("date") >= F.lit(f"{year - 1}-12-31").cast("date"))
                     & (F.col("date") <= F.lit(f"{year}-12-31").cast("date")))
    d = d.join(st.select("staid", *([F.col("temp_stat")] if "temp_stat" in stations.columns else [])),
               "staid", "left_semi" if "stat" not in daily.columns else "inner")
    if "stat" in daily.columns:
        keep = (((F.col("code") == discharge_code) & (F.col("stat") == "00003"))
                | ((F.col("code") == temp_code) & (F.col("stat") == F.col("temp_stat"))))
        d = d.filter(keep)
    agg = d.groupBy("staid", "date").agg(
        F.avg(F.when(F.col("code") == discharge_code, F.col("val"))).alias("discharge"),
        F.avg(F.when(F.col("code") == temp_code, F.col("val"))).alias("temp"))
    return (agg.join(st.select("staid", "sta_name", "rvr_code"), "staid", "left")
            .withColumn("last_modified", as_of_col(as_of)))


def tag_list(fish_tbl: DataFrame) -> DataFrame:
    """Tagged fish with reach and tag fields."""
    return (fish_tbl.filter(F.col("pit_id").isNotNull())
            .select("spp_code", "rch_code", "datetime", "rmi", "pit_num", "pit_recap", "pit_type"))


def map_points(fish: DataFrame, site: DataFrame, species: str = "SM") -> DataFrame:
    """Fish count and mean x/y per (rmi, species, pass, epsg) for one species."""
    f = (fish.filter(F.col("epsg").isNotNull())
         .join(site.select("site_id", "pass"), "site_id", "left")
         .filter(F.col("species") == species))
    return f.groupBy("rmi", "species", "pass", "epsg").agg(
        F.count(F.lit(1)).alias("fish_count"),
        strict_mean("loc_x").alias("loc_x"), strict_mean("loc_y").alias("loc_y"))


def year_fish(site: DataFrame, fish: DataFrame, years, how: str = "inner") -> DataFrame:
    """Fish of sites in ``years``: inner join with the site columns, or a semi-join."""
    s = site.filter(F.col("year").isin(list(years)))
    if how in ("semi", "left_semi"):
        return fish.join(s.select("site_id"), "site_id", "left_semi")
    # columns present on both sides keep the fish value; the site's gets a suffix
    s = s.select(*[F.col(c).alias(c if c == "site_id" or c not in fish.columns else f"{c}_site")
                   for c in s.columns])
    return fish.join(s, "site_id", "inner")
