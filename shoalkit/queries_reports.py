"""Queries: distributions and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import AS_OF_SQL, T, W, YEARS, register
from .operators import distribution as dist
from .operators import profile as prof
from .plans import products
from .queries_products import _SITE_P_SQL, _SITE_P_TABLES
from .session import scratch_path
from .sources import store

register("hist_fixed_width", W("site") + """
, b AS (SELECT reach, CAST(floor((start_rmi - CAST(0 AS DOUBLE)) / CAST(5 AS DOUBLE)) AS BIGINT) AS bin FROM site
        WHERE start_rmi IS NOT NULL)
SELECT reach, bin, CAST(0 AS DOUBLE) + bin * CAST(5 AS DOUBLE) AS bin_start,
  CAST(0 AS DOUBLE) + (bin + 1) * CAST(5 AS DOUBLE) AS bin_end, count(*) AS n FROM b GROUP BY reach, bin""")(
    lambda spark, d: dist.histogram(T(spark, d).site, "start_rmi", width=5, by=["reach"]))

register("hist_n_bins", W("fish") + """
, f AS (SELECT CAST(tot_length AS DOUBLE) AS x FROM fish WHERE species = 'SM' AND tot_length IS NOT NULL)
, r AS (SELECT min(x) AS lo, max(x) AS hi FROM f)
, b AS (SELECT CASE WHEN r.hi = r.lo THEN 0 ELSE least(CAST(floor((x - r.lo) / ((r.hi - r.lo) / 30.0)) AS BIGINT), 29) END AS bin,
          r.lo, r.hi FROM f, r)
SELECT bin, lo + bin * ((hi - lo) / 30.0) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30.0) AS bin_end, count(*) AS n
FROM b GROUP BY bin, lo, hi""")(
    lambda spark, d: dist.histogram(T(spark, d).fish.filter(F.col("species") == "SM"), "tot_length", bins=30))

register("hist_n_bins_by_reach", W("site", "fish") + """
, f AS (SELECT s.reach, CAST(f.rmi AS DOUBLE) AS x FROM fish f JOIN site s ON f.site_id = s.site_id WHERE f.rmi IS NOT NULL)
, r AS (SELECT reach, min(x) AS lo, max(x) AS hi FROM f GROUP BY reach)
, b AS (SELECT f.reach, CASE WHEN r.hi = r.lo THEN 0 ELSE least(CAST(floor((x - r.lo) / ((r.hi - r.lo) / 30.0)) AS BIGINT), 29) END AS bin,
          r.lo, r.hi FROM f JOIN r ON f.reach IS NOT DISTINCT FROM r.reach)
SELECT reach, bin, lo + bin * ((hi - lo) / 30.0) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30.0) AS bin_end, count(*) AS n
FROM b GROUP BY reach, bin, lo, hi""")(
    lambda spark, d: dist.histogram(
        T(spark, d).fish.join(T(spark, d).site.select("site_id", "reach"), "site_id"), "rmi", bins=30,
        by=["reach"], per_group_range=True))

register("bar_count", W("fish", "pittag") + """
SELECT f.species AS spp_code, count(*) AS n FROM fish f JOIN pittag p ON f.fish_id = p.fish_id
WHERE p.pit_num IS NOT NULL GROUP BY f.species""")(
    lambda spark, d: dist.bar_counts(
        T(spark, d).fish.join(T(spark, d).pittag.select("fish_id", "pit_num"), "fish_id", "left")
        .filter(F.col("pit_num").isNotNull()).withColumnRenamed("species", "spp_code"), "spp_code"))

_PROF_COLS = ["site_id", "key_a", "project_code", "year", "river", "reach", "pass", "startdatetime", "el_sec",
              "start_rmi", "crew", "upload_id"]
_PROF_TYPES = {"site_id": "string", "key_a": "bigint", "project_code": "string", "year": "int", "river": "string",
               "reach": "string", "pass": "int", "startdatetime": "timestamp_ntz", "el_sec": "int",
               "start_rmi": "double", "crew": "string", "upload_id": "int"}


def _prof_sql():
    parts = []
    for c in _PROF_COLS:
        parts.append(f"""SELECT '{c}' AS "column", '{_PROF_TYPES[c]}' AS type, count(*) AS n,
  count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_distinct,
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
  (SELECT min(v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM p WHERE {c} IS NOT NULL GROUP BY 1) t
   WHERE k = (SELECT max(k2) FROM (SELECT count(*) AS k2 FROM p WHERE {c} IS NOT NULL GROUP BY {c}) u)) AS mode FROM p""")
    return "\nUNION ALL ".join(parts)


register("prof_columns", W("site") + ", p AS (SELECT " + ", ".join(_PROF_COLS) + " FROM site)\n" + _prof_sql())(
    lambda spark, d: prof.profile(T(spark, d).site.select(*_PROF_COLS)))


def _q_labels(spark, d):
    t = T(spark, d)
    site_tbl = products.site_product(t.site, t.tbl_river, t.tbl_reach, t.water_qual, t.meta, YEARS)
    return prof.with_labels(site_tbl, prof.SITE_LABELS)


register("prof_labels", W(*_SITE_P_TABLES) + _SITE_P_SQL + f"\nSELECT *, {AS_OF_SQL} AS last_modified FROM sp")(_q_labels)


_STORED = ["site_id", "year", "reach", "pass", "el_sec", "start_rmi", "crew"]
_NUMBERS = ["year", "pass", "el_sec", "start_rmi"]


def _q_store_profile(spark, d):
    """Profile of a stored table from the states of three loads, held against the rows: exact
    counts and ends, and whether the estimates are within their errors."""
    site = T(spark, d).site.select("upload_id", *_STORED)
    root = scratch_path(spark, "store")
    for low, high in ((1, 1), (2, 2), (3, 4)):
        store.append(spark, {"site": site.filter(F.col("upload_id").between(low, high)).drop("upload_id")}, root, sketch=True)
    got = store.profile(spark, root, "site")
    said = {r["column"]: r for r in got.collect()}  # a row a column
    tests = []
    for c in _STORED:
        n = F.count_distinct(c)
        tests.append((F.abs(n - F.lit(said[c]["n_distinct"])) <= F.greatest(F.lit(1), n * 0.04)).alias(f"d_{c}"))
        for q in (25, 50, 75) if c in _NUMBERS else ():
            v = F.lit(float(said[c][f"q{q}"]))
            below, upto = F.avg((F.col(c) < v).cast("int")), F.avg((F.col(c) <= v).cast("int"))
            tests.append(((below <= q / 100 + 0.01) & (upto >= q / 100 - 0.01)).alias(f"q{q}_{c}"))
    one = site.agg(*tests)
    rows = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"d_{c}").alias("distinct_ok"),
                              (F.col(f"q25_{c}") & F.col(f"q50_{c}") & F.col(f"q75_{c}") if c in _NUMBERS else F.lit(True)).alias("quantiles_ok")) for c in _STORED])
    ok = one.select(F.explode(rows).alias("r")).select("r.*")
    got = got.join(ok, F.col("column") == F.col("c"))
    return got.select("column", "n", "n_missing", "min", "max", F.when(F.col("column").isin("reach", "crew"), F.col("mode")).alias("mode"), "distinct_ok", "quantiles_ok")


def _store_profile_sql():
    mode = lambda c: f"""(SELECT min(v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM site WHERE {c} IS NOT NULL GROUP BY 1
      QUALIFY rank() OVER (ORDER BY count(*) DESC) = 1))"""  # noqa: E731
    return W("site") + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS n_missing, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
  {mode(c) if c in ("reach", "crew") else "CAST(NULL AS VARCHAR)"} AS mode, true AS distinct_ok, true AS quantiles_ok FROM site""" for c in _STORED)


register("prof_store", _store_profile_sql())(_q_store_profile)
