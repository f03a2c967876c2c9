"""Grouped aggregates: counts, means, length statistics, ``complete`` and next numbers.

All aggregates are built-in Catalyst aggregates, so Spark does a partial (map-side)
aggregation before the shuffle: a hot key that holds a third of the rows is reduced
to one row per task before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import r_round, strict_mean

# Largest number of distinct right-hand combinations ``complete`` ships to the
# executors as a literal list (one expression node each). Above it the values travel
# as a table of chunks, broadcast or shuffled as AQE decides by their bytes.
MAX_LITERAL_VALUES = 1_000
_CHUNK = 10_000


def count_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """``group_by(keys) %>% summarise(name = n())``; NULL is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_nesting(df: DataFrame, keys) -> DataFrame:
    """Distinct combinations of ``keys`` present in the data."""
    return df.select(*keys).distinct()


def mean_point(df: DataFrame, keys, x: str, y: str, strict: bool = False,
               x_name: str | None = None, y_name: str | None = None,
               drop_missing: bool = True) -> DataFrame:
    """Mean x/y per group.

    ``strict=False`` skips NULLs (``na.rm = TRUE``); a group with only NULLs gives a
    NULL mean and, with ``drop_missing``, is dropped (the reference's ``!is.na``).
    ``strict=True`` gives NULL when any member is NULL.
    """
    agg = strict_mean if strict else F.avg
    out = df.groupBy(*keys).agg(agg(x).alias(x_name or x), agg(y).alias(y_name or y))
    if drop_missing and not strict:
        out = out.filter(F.col(x_name or x).isNotNull())
    return out


def length_stats(df: DataFrame, keys, value: str, digits: int = 2,
                 prefix: str = "") -> DataFrame:
    """Mean (rounded), min, max and sample standard deviation per group, NULLs skipped."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        r_round(F.avg(v), digits).alias(f"mean_{prefix}"),
        F.min(v).alias(f"min_{prefix}"),
        F.max(v).alias(f"max_{prefix}"),
        F.stddev_samp(v).alias(f"sd_{prefix}"),
    )


def next_number_col(col: str, suffix_regex: str | None = None) -> Column:
    """Aggregate expression ``max(col) + 1`` (0 + 1 on an empty table).

    With ``suffix_regex`` the number is the integer captured by the regex's first group
    (e.g. the digits after the last ``_`` of a site id); the max is numeric, so it does
    not wrap at 1000 the way a text max of a 3-character suffix would.
    """
    c = F.col(col)
    if suffix_regex is not None:
        c = F.regexp_extract(c.cast("string"), suffix_regex, 1)
        c = F.when(c == "", None).otherwise(c).cast("long")
    return F.coalesce(F.max(c).cast("long"), F.lit(0)) + 1


def next_number(df: DataFrame, col: str, suffix_regex: str | None = None,
                name: str = "next_number") -> DataFrame:
    """One-row ``max(col) + 1`` table (see ``next_number_col``)."""
    return df.agg(next_number_col(col, suffix_regex).alias(name))


def _literal_rows(df: DataFrame, cols, bound: int):
    """Collect at most ``bound`` distinct rows of ``cols``; None when there are more."""
    rows = df.select(*cols).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        return None
    return rows


def _struct_literal(row, cols, types) -> Column:
    return F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in cols])


def expand_grid(left: DataFrame, right_values: DataFrame, right_cols,
                values=None, bound: int = MAX_LITERAL_VALUES, chunk: int = _CHUNK) -> DataFrame:
    """Every row of ``left`` paired with every distinct combination of ``right_cols``.

    This is ``tidyr::complete``'s grid. The right-hand set is a domain (species, life
    stages), so it is counted first: up to ``bound`` values it travels as a literal
    array that each left row explodes (no shuffle, no join). Above the bound the right
    set is split into chunks of ``chunk`` values, each left row is repeated once per
    chunk, and the pairs come from an equi-join on the chunk number.
    """
    right_cols = list(right_cols)
    types = {f.name: f.dataType for f in right_values.schema.fields if f.name in right_cols}
    rows = values if values is not None else _literal_rows(right_values, right_cols, bound)
    if rows is not None:
        if not rows:
            return left.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in right_cols]).limit(0)
        arr = F.array(*[_struct_literal(r, right_cols, types) for r in rows])
        return (left.withColumn("_grid", F.explode(arr))
                .select(*[F.col(c) for c in left.columns],
                        *[F.col(f"_grid.{c}").alias(c) for c in right_cols]))
    # chunked path for a large right-hand set: K chunk rows, each left row repeated K
    # times and paired with its chunk through an equi-join on the chunk number
    distinct_right = right_values.select(*right_cols).distinct()
    n_values = distinct_right.count()
    n_chunks = max(1, -(-n_values // chunk))
    chunks = (distinct_right
              .withColumn("_chunk", F.pmod(F.xxhash64(*right_cols), F.lit(n_chunks)))
              .groupBy("_chunk")
              .agg(F.collect_list(F.struct(*right_cols)).alias("_vals")))
    reps = left.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)).cast("array<bigint>")))
    return (reps.join(chunks, "_chunk")
            .withColumn("_grid", F.explode("_vals"))
            .select(*[F.col(c) for c in left.columns],
                    *[F.col(f"_grid.{c}").alias(c) for c in right_cols]))


def complete(df: DataFrame, left, right, fill: dict | None = None,
             values=None, bound: int = MAX_LITERAL_VALUES) -> DataFrame:
    """``complete(nesting(left...), nesting(right...), fill = fill)``.

    Output: every seen ``left`` combination x every seen ``right`` combination; rows of
    ``df`` are kept as they are, absent pairs are added with ``fill`` values (other
    columns NULL). Key equality is NULL-safe: NULL is a value here, as in tidyr.
    """
    left, right = list(left), list(right)
    fill = fill or {}
    keys = left + right
    grid = expand_grid(df.select(*left).distinct(), df, right, values=values, bound=bound)
    cond = None
    g = grid.alias("_g")
    d = df.alias("_d")
    for k in keys:
        e = F.col(f"_g.{k}").eqNullSafe(F.col(f"_d.{k}"))
        cond = e if cond is None else cond & e
    joined = g.join(d, cond, "left")
    others = [c for c in df.columns if c not in keys]
    out_cols = [F.col(f"_g.{k}").alias(k) for k in keys]
    for c in others:
        col = F.col(f"_d.{c}")
        if c in fill:
            col = F.coalesce(col, F.lit(fill[c]))
        out_cols.append(col.alias(c))
    return joined.select(*out_cols).select(*df.columns)
