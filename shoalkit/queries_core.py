"""Queries: effort, CPUE and aggregation keys."""

from __future__ import annotations


from .catalog import AS_OF_SQL, T, W, YEARS, register
from .operators import aggregate as agg
from .plans import effort

_Y = ", ".join(str(y) for y in YEARS)

# ---------------------------------------------------------------- dp_cpue
register("dp_cpue", W("site", "fish") + f"""
, s AS (SELECT site_id, el_sec, river AS rvr_code, reach AS rch_code, startdatetime FROM site WHERE year IN ({_Y}))
, c AS (SELECT f.site_id, f.species, count(*) AS n FROM fish f JOIN s ON f.site_id = s.site_id
        WHERE f.species IS NOT NULL GROUP BY f.site_id, f.species)
, sp AS (SELECT DISTINCT species FROM c)
SELECT s.site_id, s.el_sec, s.rvr_code, s.rch_code, s.startdatetime, sp.species AS spp_code,
  coalesce(c.n, 0) AS fish_ct,
  round_even(CASE WHEN s.el_sec = 0 THEN NULL ELSE coalesce(c.n, 0) / (s.el_sec / 3600) END, 2) AS cpue,
  {AS_OF_SQL} AS last_modified
FROM s CROSS JOIN sp LEFT JOIN c ON c.site_id = s.site_id AND c.species = sp.species
""")(lambda spark, d: effort.cpue(T(spark, d).site, T(spark, d).fish, YEARS))


# ---------------------------------------------------------------- agg_complete
def _q_complete(spark, d):
    counts = agg.count_by(T(spark, d).fish, ["site_id", "species"], "n")
    return agg.complete(counts, ["site_id"], ["species"], fill={"n": 0})


register("agg_complete", W("fish") + """
, c AS (SELECT site_id, species, count(*) AS n FROM fish GROUP BY site_id, species)
, l AS (SELECT DISTINCT site_id FROM c), r AS (SELECT DISTINCT species FROM c)
SELECT l.site_id, r.species, coalesce(c.n, 0) AS n
FROM l CROSS JOIN r LEFT JOIN c ON c.site_id = l.site_id AND c.species IS NOT DISTINCT FROM r.species
""")(_q_complete)


# ---------------------------------------------------------------- agg_count_group
def _q_count_group(spark, d):
    t = T(spark, d)
    j = t.fish.join(t.site.select("site_id", "reach", "pass"), "site_id", "left")
    return agg.count_by(j, ["reach", "pass", "species"], "n")


register("agg_count_group", W("site", "fish") + """
SELECT s.reach, s.pass, f.species, count(*) AS n
FROM fish f LEFT JOIN site s ON f.site_id = s.site_id
GROUP BY s.reach, s.pass, f.species
""")(_q_count_group)
