"""Joins: lookups, natural joins, NULL-safe joins and small range joins.

No join carries a broadcast hint: Catalyst (by its size estimate) and AQE (by the bytes
it measured) broadcast a side below ``spark.sql.autoBroadcastJoinThreshold``, and use
sort-merge with skew-join splitting otherwise. Range joins go over an index of the bounds'
elementary pieces and plan as equi-joins, never as nested loops over both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def _eq(a, b, null_safe: bool):
    return a.eqNullSafe(b) if null_safe else a == b


def keyed_join(left: DataFrame, right: DataFrame, on: dict, how: str = "left",
               null_safe: bool = False) -> DataFrame:
    """Join on ``{left_col: right_col}``; one output column per key pair.

    Keys keep the left name; for right/full joins the key is coalesced so rows only on
    the right keep their key. Right key columns are dropped. A full join runs as
    ``_full_join`` (two skew-splittable parts) instead of a full outer sort-merge join.
    """
    if how in ("full", "full_outer", "outer", "fullouter"):
        return _full_join(left, right, on, null_safe)
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for lk, rk in on.items():
        e = _eq(F.col(f"_l.{lk}"), F.col(f"_r.{rk}"), null_safe)
        cond = e if cond is None else cond & e
    j = l.join(r, cond, how)
    cols = []
    rkeys = set(on.values())
    for c in left.columns:
        if c in on and how in ("right", "right_outer"):
            cols.append(F.coalesce(F.col(f"_l.{c}"), F.col(f"_r.{on[c]}")).alias(c))
        else:
            cols.append(F.col(f"_l.{c}").alias(c))
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return j.select(*cols)
    lnames = set(left.columns)
    for c in right.columns:
        if c in rkeys:
            continue
        name = c if c not in lnames else f"{c}_r"
        cols.append(F.col(f"_r.{c}").alias(name))
    return j.select(*cols)


def _full_join(left: DataFrame, right: DataFrame, on: dict, null_safe: bool) -> DataFrame:
    """Full outer join as (right LEFT JOIN left) UNION ALL (left rows with no right key).

    AQE cannot split a skewed partition of a full outer sort-merge join, so a key that
    holds a third of the child rows would sit in one task. Here the child (right) side
    is the streamed side of a left outer join, which AQE splits, and the unmatched
    parents come from an anti-join against the right side's *distinct* keys, which are
    reduced map-side before they move.
    """
    inv = {rk: lk for lk, rk in on.items()}
    matched = keyed_join(right, left, inv, "left", null_safe)  # right columns first
    rkeys = right.select(*[F.col(rk).alias(lk) for lk, rk in on.items()]).distinct()
    lonly = keyed_join(left, rkeys, {k: k for k in on}, "left_anti", null_safe)
    lnames = set(left.columns)
    rnames = {c: (c if c not in lnames else f"{c}_r") for c in right.columns if c not in inv}
    out_cols = list(left.columns) + list(rnames.values())
    m_sel = []
    for c in left.columns:
        if c in on:
            m_sel.append(F.col(on[c]).alias(c))
        else:
            src = c if c not in set(right.columns) or c in on else f"{c}_r"
            m_sel.append(F.col(src).alias(c))
    for c, n in rnames.items():
        m_sel.append(F.col(c).alias(n))
    part1 = matched.select(*m_sel)
    types = {f.name: f.dataType for f in right.schema.fields}
    part2 = lonly.select(*[F.col(c) for c in left.columns],
                         *[F.lit(None).cast(types[c]).alias(n) for c, n in rnames.items()])
    return part1.unionByName(part2).select(*out_cols)


def lookup(df: DataFrame, dim: DataFrame, on: dict, null_safe: bool = False) -> DataFrame:
    """Left lookup of a small dimension by code (names may differ: ``{'reach': 'rch_code'}``)."""
    return keyed_join(df, dim, on, "left", null_safe)


def natural_join(a: DataFrame, b: DataFrame, how: str = "full", null_safe: bool = False) -> DataFrame:
    """Join on every shared column name (dplyr's default ``by``)."""
    shared = [c for c in a.columns if c in b.columns]
    return keyed_join(a, b, {c: c for c in shared}, how, null_safe)


def null_safe_join(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join where NULL matches NULL (local R frames)."""
    return keyed_join(a, b, {c: c for c in on}, how, null_safe=True)


def full_join(a: DataFrame, b: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """Full outer join on ``on`` with coalesced keys."""
    return keyed_join(a, b, {c: c for c in on}, "full", null_safe)


def _elementary(bounds: DataFrame) -> DataFrame:
    """(_k, _p, _next, _rank, _depth, _lo, _w, _n): the pieces between a key's breakpoints in
    order, how many bounds cover each, and the key's grid: least breakpoint, cell width, cells."""
    ends = F.array(F.struct(F.col("_from").alias("p"), F.lit(1).alias("d")), F.struct(F.col("_to").alias("p"), F.lit(-1).alias("d")))
    points = bounds.select("_k", F.explode(ends).alias("e")).select("_k", F.col("e.p").alias("_p"), F.col("e.d").alias("d")).filter("_p is not null")
    points = points.groupBy("_k", "_p").agg(F.sum("d").alias("d"))  # an open end has no breakpoint
    own = Window.partitionBy("_k")
    at = own.orderBy("_p")
    x = F.col("_p").cast("double")
    lo, n = F.min(x).over(own), F.count(F.lit(1)).over(own)
    points = points.select("_k", "_p", F.lead("_p").over(at).alias("_next"), (F.row_number().over(at) - 1).alias("_rank"),
                           F.sum("d").over(at).alias("_depth"), lo.alias("_lo"), ((F.max(x).over(own) - lo) / n).alias("_w"), n.cast("int").alias("_n"))
    return points.withColumn("_w", F.when(F.col("_w") > 0, F.col("_w")).otherwise(1.0))


def _cell(value, lo="_lo", w="_w", n="_n"):
    """The grid cell of a value: never falls as the value rises."""
    return F.least(F.floor((value.cast("double") - F.col(lo)) / F.col(w)), (F.col(n) - 1).cast("long")).cast("int")


def _nodes(a, b, levels: int):
    """The fewest nodes of a binary tree over ranks that make up ``a <= rank < b``, as (level, node)."""
    def step(s, level):
        left, right = s["l"] % 2 == 1, s["r"] % 2 == 1
        node = lambda test, at: F.when((s["l"] < s["r"]) & test, F.struct(level.alias("level"), at.alias("node")))
        some = F.array(node(left, s["l"]), node(right & (F.when(left, s["l"] + 1).otherwise(s["l"]) < s["r"]), s["r"] - 1))
        on = F.when(left, s["l"] + 1).otherwise(s["l"])
        off = F.when(right, s["r"] - 1).otherwise(s["r"])
        open_ = s["l"] < s["r"]
        return F.struct(F.when(open_, F.floor(on / 2).cast("int")).otherwise(0).alias("l"), F.when(open_, F.floor(off / 2).cast("int")).otherwise(0).alias("r"),
                        F.concat(s["out"], F.array_compact(some)).alias("out"))
    start = F.struct(a.cast("int").alias("l"), b.cast("int").alias("r"), F.array().cast("array<struct<level:int,node:int>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda s: s["out"])


def interval_join(df: DataFrame, key: str, value: str, bounds: DataFrame, payload) -> DataFrame:
    """Left join of each row with the bounds of its key that hold its value: ``_from <= value < _to``.

    ``bounds``: (_k, _from, _to, *payload); an open ``_to`` is NULL. Bounds may overlap in any
    number. A key's breakpoints cut its line into elementary pieces; a row finds its piece by
    an equi-join on the cell of an even grid over the key's line (as many cells as pieces), so
    the rows of one key are dealt over its cells. Each bound is cut into the few nodes of a
    binary tree over the pieces that make it up, and a row asks the node above its piece on
    each level: an equi-join that meets each matching bound exactly once. No bound is held
    against rows outside it, whatever a key's share of the rows.
    """
    payload = list(payload)
    b = bounds.select("_k", "_from", "_to", *payload).filter("_k is not null and _from is not null and (_to is null or _from < _to)")
    pieces = _elementary(b)
    most = pieces.agg(F.max("_n").alias("n")).first()["n"] or 1  # one number
    levels = int(most - 1).bit_length()
    grid = pieces.select("_k", "_lo", "_w", "_n").distinct()
    rank = pieces.select(F.col("_k").alias("_rk"), F.col("_p").alias("_rp"), F.col("_rank").alias("_r"))
    b = b.join(rank.select("_rk", F.col("_rp").alias("_fp"), F.col("_r").alias("_a")), (F.col("_k") == F.col("_rk")) & (F.col("_from") == F.col("_fp"))).drop("_rk", "_fp")
    b = b.join(rank.select("_rk", F.col("_rp").alias("_tp"), F.col("_r").alias("_b")), (F.col("_k") == F.col("_rk")) & (F.col("_to") == F.col("_tp")), "left").drop("_rk", "_tp")
    b = b.join(grid.select(F.col("_k").alias("_gk"), F.col("_n").alias("_gn")), F.col("_k") == F.col("_gk"))
    b = b.select(F.col("_k").alias("_bk"), F.explode(_nodes(F.col("_a"), F.when(F.col("_to").isNull(), F.col("_gn")).otherwise(F.col("_b")), levels)).alias("_x"), *[F.col(c).alias(f"_out_{c}") for c in payload])
    b = b.select("_bk", F.col("_x.level").alias("_bl"), F.col("_x.node").alias("_bn"), *[f"_out_{c}" for c in payload])
    cells = pieces.withColumn("_c", F.explode(F.sequence(_cell(F.col("_p")), F.coalesce(_cell(F.col("_next")), F.col("_n") - 1))))
    cells = cells.select(F.col("_k").alias("_ck"), "_c", F.col("_p").alias("_from"), F.col("_next").alias("_to"), "_rank", "_depth")
    grid = grid.withColumnRenamed("_k", "_gk")
    d = df.join(grid, F.col(key) == F.col("_gk"), "left").withColumn("_own", _cell(F.col(value)))
    here = (F.col("_gk") == F.col("_ck")) & (F.col("_own") == F.col("_c")) & (F.col(value) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(value) < F.col("_to")))
    d = d.join(cells, here, "left")
    up = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda i: F.struct(i.alias("level"), F.call_function("shiftright", F.col("_rank"), i).alias("node")))
    none = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).alias("node")))
    # rows that no bound holds ask one node that is not there, and stay
    d = d.withColumn("_ask", F.explode(F.when(F.col("_depth") > 0, up).otherwise(none)))
    d = d.join(b, (F.col("_gk") == F.col("_bk")) & (F.col("_ask.level") == F.col("_bl")) & (F.col("_ask.node") == F.col("_bn")), "left")
    d = d.filter(F.col("_bk").isNotNull() | (F.col("_ask.level") == -1))
    return d.select(*[F.col(c) for c in df.columns], *[F.col(f"_out_{c}").alias(c) for c in payload])


def life_stage(df: DataFrame, bounds: DataFrame, species: str = "species",
               length: str = "tot_length") -> DataFrame:
    """Life stage by species and length class: ``min_len <= length < max_len``.

    ``bounds``: (species, life_stage, min_len, max_len); a NULL max is open. Left join,
    so an unknown species or length keeps a NULL stage.
    """
    b = bounds.select(F.col("species").alias("_k"), F.col("min_len").alias("_from"), F.col("max_len").alias("_to"), "life_stage")
    return interval_join(df, species, length, b, ["life_stage"])


def assign_reach(df: DataFrame, bounds: DataFrame, river: str = "rvr_code", mile: str = "mid_rmi",
                 out: str = "reach") -> DataFrame:
    """Reach by river and river mile: ``min_rmi <= mile < max_rmi`` within the river.

    ``bounds``: (rvr_code, rch_code, min_rmi, max_rmi). Left join; no match -> NULL.
    """
    b = bounds.filter(F.col("max_rmi").isNotNull())
    b = b.select(F.col("rvr_code").alias("_k"), F.col("min_rmi").alias("_from"), F.col("max_rmi").alias("_to"), F.col("rch_code").alias(out))
    return interval_join(df, river, mile, b, [out])
