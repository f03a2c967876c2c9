"""Mergeable column states: a profile of a growing table without reading its old rows.

Each column of a batch is reduced to one row of states -- counts, smallest and largest
value, a HyperLogLog sketch (distinct values), a KLL sketch (quantiles) and a
most-frequent-items sketch --, all built-in aggregates with map-side combine. States of
batches merge into those of all their rows, so a table's profile costs a row a column and
batch, whatever its size. ``profile`` (operators/profile.py) is the exact mode.

Errors: distinct counts 0.8 % (one standard deviation, ``LG``), quantiles 0.5 % in rank
(``KLL``, 99 times of 100), the most frequent value is exact where a column has no more
than ``ITEMS`` / 4 * 3 values and else one whose count is near the largest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG, KLL, ITEMS = 14, 800, 4096
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _text(c: Column, kind: T.DataType) -> Column:
    return c.cast("string") if not isinstance(kind, T.BinaryType) else F.hex(c)


def column_states(df: DataFrame) -> DataFrame:
    """One row per column: column, type, n, n_missing, low, high, low_n, high_n, distinct, spread, often."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        text = F.when(c.isNotNull(), _text(c, f.dataType))
        aggs += [F.count_if(c.isNull()).alias(f"m{i}"),
                 (F.lit(None).cast("string") if number else F.min(text)).alias(f"lo{i}"),
                 (F.lit(None).cast("string") if number else F.max(text)).alias(f"hi{i}"),
                 (F.min(c).cast("double") if number else F.lit(None).cast("double")).alias(f"ln{i}"),
                 (F.max(c).cast("double") if number else F.lit(None).cast("double")).alias(f"hn{i}"),
                 F.hll_sketch_agg(text, LG).alias(f"d{i}"),
                 F.kll_sketch_agg_double(c.cast("double") if number else F.lit(None).cast("double"), KLL).alias(f"q{i}"),
                 F.call_function("approx_top_k_accumulate", text, F.lit(ITEMS)).alias(f"t{i}")]
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col("_rows").alias("n"), F.col(f"m{i}").alias("n_missing"),
                 F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"), F.col(f"ln{i}").alias("low_n"), F.col(f"hn{i}").alias("high_n"),
                 F.col(f"d{i}").alias("distinct"), F.col(f"q{i}").alias("spread"), F.col(f"t{i}").alias("often"))
        for i, f in enumerate(df.schema.fields)]))
    return df.agg(*aggs).select(rows.alias("r")).select("r.*")


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column and type: the states of all rows that the given ones stand for."""
    return states.groupBy("column", "type").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_n").alias("low_n"), F.max("high_n").alias("high_n"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("spread", KLL).alias("spread"), F.call_function("approx_top_k_combine", "often", F.lit(ITEMS)).alias("often"))


def read_states(states: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """The profile that merged states tell: column, type, n, n_missing, n_distinct, min, max, mode, q<pct> (numbers as text)."""
    def number(c: Column) -> Column:
        return F.when(F.col("type").isin([t().simpleString() for t in _WHOLE]), c.cast("bigint").cast("string")).otherwise(c.cast("string"))

    some = F.kll_sketch_get_n_double("spread") > 0
    qs = [number(F.when(some, F.kll_sketch_get_quantile_double("spread", F.lit(float(q))))).alias(f"q{round(q * 100)}") for q in quantiles]
    top = F.call_function("approx_top_k_estimate", "often", F.lit(1))
    return states.select("column", "type", "n", "n_missing", F.hll_sketch_estimate("distinct").alias("n_distinct"),
                         F.coalesce("low", number(F.col("low_n"))).alias("min"), F.coalesce("high", number(F.col("high_n"))).alias("max"),
                         F.get(top, F.lit(0))["item"].alias("mode"), *qs)
