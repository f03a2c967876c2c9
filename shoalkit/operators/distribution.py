"""Histograms and bar counts: the tables behind the reference's plots.

Bins are left-closed, ``[start, start + width)``; with a bin count the width is
(max - min) / bins and the maximum goes into the last bin. NULL values are left out
(the plotting library drops them). The counts are grouped aggregates (partial
aggregation before the shuffle); the data range is one aggregate row per facet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import keyed_join


def histogram(df: DataFrame, col: str, width: float | None = None, bins: int | None = None,
              by=(), boundary: float = 0.0, per_group_range: bool = False) -> DataFrame:
    """Counts per (facet..., bin) with ``bin_start``/``bin_end``.

    Give ``width`` (fixed bins anchored at ``boundary``) or ``bins`` (equal bins over
    the data range; per facet when ``per_group_range``).
    """
    by = list(by)
    x = F.col(col)
    d = df.filter(x.isNotNull()).select(*by, x.cast("double").alias("_x"))
    if width is not None:
        w = F.lit(float(width))
        b = F.floor((F.col("_x") - F.lit(float(boundary))) / w).cast("long")
        out = d.select(*by, b.alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
        return out.select(*by, "bin", (F.lit(float(boundary)) + F.col("bin") * w).alias("bin_start"),
                          (F.lit(float(boundary)) + (F.col("bin") + 1) * w).alias("bin_end"), "n")
    if not bins:
        raise ValueError("give width or bins")
    nb = F.lit(float(bins))
    if per_group_range and by:
        rng = d.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        d = keyed_join(d, rng, {b: b for b in by}, "inner", null_safe=True)  # a NULL facet is a panel too
    else:
        lo, hi = d.agg(F.min("_x"), F.max("_x")).first()
        if lo is None:
            lo, hi = 0.0, 0.0
        d = d.withColumns({"_lo": F.lit(float(lo)), "_hi": F.lit(float(hi))})
    wd = (F.col("_hi") - F.col("_lo")) / nb
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0).cast("long")).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / wd).cast("long"), F.lit(bins - 1).cast("long")))
    out = d.select(*by, "_lo", "_hi", b.alias("bin")).groupBy(*by, "_lo", "_hi", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    wd = (F.col("_hi") - F.col("_lo")) / nb
    return out.select(*by, "bin", (F.col("_lo") + F.col("bin") * wd).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * wd).alias("bin_end"), "n")


def bar_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Bar chart table: rows per value of ``col`` (NULL is a bar of its own)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
