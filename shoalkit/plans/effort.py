"""Effort and catch-per-unit-effort products.

Shape of every plan here: fish are reduced to one row per (site, item) with a partial
aggregate before any shuffle, the site side is joined once on ``site_id``, and the
zero-filled grid is produced per site row by exploding the (size-checked) item list,
so no plan pairs all sites with all items through a join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import in_set, lenient_sum, r_round, safe_div, strict_sum
from ..operators.aggregate import MAX_LITERAL_VALUES, _literal_rows, expand_grid
from ..operators.joins import life_stage
from ..session import ensure_checkpoint_dir

# Fixed run timestamp stamped as last_modified (the reference uses now(); a parameter
# keeps products reproducible).
DEFAULT_AS_OF = _dt.datetime(2020, 12, 31, 0, 0, 0)


def as_of_col(as_of=None):
    """The run timestamp as a TIMESTAMP_NTZ literal (built from text: no time zone)."""
    ts = as_of or DEFAULT_AS_OF
    text = ts.strftime("%Y-%m-%d %H:%M:%S") if hasattr(ts, "strftime") else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def _site_item_counts(sites: DataFrame, items: DataFrame, item: str, out_item: str,
                      values=None, bound: int = MAX_LITERAL_VALUES) -> DataFrame:
    """Sites x seen items with fish counts, zeros filled.

    ``sites``: one row per site (``site_id`` + attributes). ``items``: one row per fish
    (``site_id``, ``item``); NULL items are counted nowhere but the site still gets its
    zero rows. The item list is the set seen among fish of these sites.
    """
    counts = (items.filter(F.col(item).isNotNull())
              .join(sites.select("site_id"), "site_id", "left_semi")
              .groupBy("site_id", item).agg(F.count(F.lit(1)).alias("_n")))
    if values is None:
        # the seen items are read off the counts, which the grid then uses again: keep
        # them (they are far smaller than the fish) instead of aggregating the fish twice
        ensure_checkpoint_dir(counts.sparkSession)
        counts = counts.checkpoint()
        values = _literal_rows(counts, [item], bound)
    per_site = (counts.groupBy("site_id")
                .agg(F.map_from_entries(F.collect_list(F.struct(item, "_n"))).alias("_m")))
    joined = sites.join(per_site, "site_id", "left")
    grid = expand_grid(joined, counts, [item], values=values, bound=bound)
    return (grid.withColumn("fish_ct", F.coalesce(F.try_element_at("_m", F.col(item)), F.lit(0).cast("bigint")))
            .drop("_m").withColumnRenamed(item, out_item))


def cpue(site: DataFrame, fish: DataFrame, years, as_of=None, species=None) -> DataFrame:
    """Fish per site x species with zero fill; cpue = round(n / (el_sec / 3600), 2).

    Sites come from the left side, so zero-catch sites stay with all-zero rows. Fish of
    unknown species are not a column of the grid (dropped after completion).
    """
    sites = (site.filter(F.col("year").isin(list(years)))
             .select("site_id", "el_sec", F.col("river").alias("rvr_code"),
                     F.col("reach").alias("rch_code"), "startdatetime"))
    vals = [{"species": s} for s in species] if species is not None else None
    out = _site_item_counts(sites, fish.select("site_id", "species"), "species", "spp_code",
                            values=vals)
    return out.select("site_id", "el_sec", "rvr_code", "rch_code", "startdatetime", "spp_code",
                      "fish_ct",
                      r_round(safe_div(F.col("fish_ct"), F.col("el_sec") / 3600), 2).alias("cpue"),
                      as_of_col(as_of).alias("last_modified"))


def cpue_life_stage(site: DataFrame, fish: DataFrame, bounds: DataFrame, species, years,
                    as_of=None) -> DataFrame:
    """CPUE by species_stage for target species.

    A fish of a target species whose stage is unknown (no length, or outside every
    class) keeps the text stage "NA"; only a site without target fish ("NA_NA") drops
    out after completion.
    """
    sites = (site.filter(F.col("year").isin(list(years)))
             .select("site_id", "el_sec", F.col("river").alias("rvr_code"),
                     F.col("reach").alias("rch_code"), "startdatetime"))
    target = fish.filter(in_set("species", species)).select("site_id", "species", "tot_length")
    staged = life_stage(target, bounds, "species", "tot_length")
    items = staged.select("site_id", F.concat_ws("_", "species", F.coalesce("life_stage", F.lit("NA"))).alias("ls"))
    out = _site_item_counts(sites, items, "ls", "ls")
    parts = F.split(F.col("ls"), "_", 2)
    return out.select("site_id", "el_sec", "rvr_code", "rch_code", "startdatetime",
                      parts.getItem(0).alias("spp_code"), parts.getItem(1).alias("life_stage"),
                      "fish_ct",
                      r_round(safe_div(F.col("fish_ct"), F.col("el_sec") / 3600), 2).alias("cpue"),
                      as_of_col(as_of).alias("last_modified"))


def effort_stats(site: DataFrame, fish: DataFrame, species=("SM",), keys=("pass",),
                 catch_name: str | None = None, species_col: str | None = "species") -> DataFrame:
    """Per-group effort summary (the QC stats table).

    n_site = sites in the group, effort_hr = round(sum(el_sec) / 3600, 2) (NULL if any
    el_sec is NULL), catch = fish of the species at those sites (NULLs as 0), cpue =
    round(catch / effort_hr, 2). One row per group and species (the reference repeats
    one total for every species of a longer list; here each species has its own).
    """
    keys = list(keys)
    species = list(species)
    catch_name = catch_name or "catch"
    site_stats = (site.groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("n_site"),
                       r_round(strict_sum("el_sec") / 3600, 2).alias("effort_hr")))
    catch = (fish.filter(in_set("species", species))
             .groupBy("site_id", "species").agg(F.count(F.lit(1)).alias("_ct"))
             .join(site.select("site_id", *keys), "site_id")
             .groupBy(*keys, "species").agg(F.sum("_ct").alias("_catch")))
    grid = expand_grid(site_stats, catch, ["species"], values=[{"species": s} for s in species])
    cond = [grid[k].eqNullSafe(catch[k]) for k in keys] + [grid["species"] == catch["species"]]
    j = grid.join(catch, cond, "left")
    out = j.select(*[grid[k] for k in keys], grid["species"].alias("_sp"), "n_site", "effort_hr",
                   F.coalesce(catch["_catch"], F.lit(0).cast("bigint")).alias(catch_name))
    out = out.withColumn("cpue", r_round(safe_div(F.col(catch_name), F.col("effort_hr")), 2))
    cols = [*keys, "n_site", "effort_hr", catch_name, "cpue"]
    if species_col:
        return out.select(*cols, F.col("_sp").alias(species_col))
    return out.select(*cols)


def cpue_by(site: DataFrame, fish: DataFrame, keys=("pass", "reach")) -> DataFrame:
    """Two-level CPUE from the fish side (sites without fish are not counted).

    Level 1 counts fish per (site, species) and completes the site x species grid with
    zeros (NULL species is one of the values); level 2 sums per (keys, species):
    effort = round(sum(el_sec / 3600), 2), catch, cpue = round(catch / effort, 2).
    Effort is the same for every species of a group, so the grid is never built row by
    row: group effort is paired with the species list and the catch joined on.
    """
    keys = list(keys)
    fs = fish.select("site_id", "species").join(
        site.select("site_id", *keys, "el_sec"), "site_id", "left")
    # sites seen through their fish (an orphan fish forms a site with NULL attributes)
    seen = fs.select("site_id", *keys, "el_sec").distinct()
    # sum(el_sec / 3600) summed exactly: integer seconds first, one division, so the
    # rounding does not depend on the order in which partial sums meet
    effort = seen.groupBy(*keys).agg(r_round(strict_sum("el_sec") / 3600, 2).alias("effort"))
    catch = fs.groupBy(*keys, "species").agg(F.count(F.lit(1)).alias("_catch"))
    grid = expand_grid(effort, catch, ["species"])
    cond = [grid[k].eqNullSafe(catch[k]) for k in keys] + [grid["species"].eqNullSafe(catch["species"])]
    j = grid.join(catch, cond, "left")
    out = j.select(*[grid[k] for k in keys], grid["species"], "effort",
                   F.coalesce(catch["_catch"], F.lit(0).cast("bigint")).alias("catch"))
    return out.withColumn("cpue", r_round(safe_div(F.col("catch"), F.col("effort")), 2))


def cpue_rollup(cpue_table: DataFrame, species: str = "SM", keys=("reach",)) -> DataFrame:
    """Third level: one species by ``keys`` over the rounded efforts (NULLs skipped)."""
    return (cpue_table.filter(F.col("species") == species)
            .groupBy(*keys)
            .agg(lenient_sum("effort").alias("effort"), lenient_sum("catch").alias("catch"))
            .withColumn("cpue", r_round(safe_div(F.col("catch"), F.col("effort")), 2)))
