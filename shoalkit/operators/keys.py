"""Global row numbers and composite keys without a single-partition window.

``row_number() over (order by ts)`` with no partition puts the whole table in one
task. ``global_index`` numbers narrow rows instead: the order columns alone (which name a
row, as they hold an explicit tie-break) are range-partitioned -- Spark samples the
composite key, so a timestamp shared by a third of the rows is still split by the
tie-break --, sorted inside partitions and tagged with partition and position. That
narrow layout is sealed with a reliable checkpoint in the shared checkpoint folder; rows
are counted per partition (one number per partition reaches the driver: bounded by the
partition count, not by the data), a broadcast of one row per partition turns positions
into numbers, and the numbers join back to the rows on the order columns.

Why the layout must be kept: the counts and the numbering are two jobs, and a range
exchange planned twice samples its bounds twice. The checkpoint gives both one physical
layout, survives executor loss without recomputation, and holds nothing but the order
columns; the rows themselves are neither sorted nor written, so what reads a few columns
of an indexed table scans a few columns.

``dealt_index`` is for tables whose whole rows are wanted: it writes them once with their
range, cut at sampled order values, and moves them once, to the ranges, where
``global_index`` moves the order columns three times and the rows to them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import pad_int, paste
from ..session import ensure_checkpoint_dir, released, sealed
from .projection import pack_texts, unpack_texts

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _sealed(keys: DataFrame, partitions: int | None) -> DataFrame:
    """The order columns, sorted over range partitions, with partition and position in ``_rid``."""
    cols = [F.col(c).asc_nulls_last() for c in keys.columns]
    # without an explicit count AQE sizes the ranges from the data: it merges only
    # contiguous ranges, so partition order is still the global order
    ranged = keys.repartitionByRange(partitions, *cols) if partitions else keys.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols).withColumn("_rid", F.monotonically_increasing_id())
    ensure_checkpoint_dir(keys.sparkSession)
    return ranged.checkpoint(eager=True)


def _numbered(df: DataFrame, order: list[str], partitions: int | None) -> tuple[DataFrame, bool]:
    """(distinct order values with the number of their first row and their rows, whether any repeat)."""
    spark, ranged = df.sparkSession, _sealed(df.select(*order), partitions)
    pid = F.shiftright(F.col("_rid"), _POS_BITS)
    rows = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect()
    counts = {r["_pid"]: r["_n"] for r in rows}
    offsets, acc = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(acc)
        acc += counts.get(p, 0)
    # one (partition, offset) row per partition: bounded by the partition count
    off = spark.createDataFrame(list(enumerate(offsets)), "_pid long, _off long")
    at = F.col("_off") + F.col("_rid").bitwiseAND(F.lit(_POS_MASK))
    first = ranged.join(F.broadcast(off), pid == F.col("_pid")).groupBy(*order).agg(F.min(at).alias("_at"), F.count(F.lit(1)).alias("_n"))
    return first, not first.filter("_n > 1").isEmpty()


def global_index(df: DataFrame, order, name: str = "index", start: int = 1,
                 partitions: int | None = None, ties=()) -> DataFrame:
    """Gap-free 1..n (from ``start``) in the order of the columns ``order``, NULLs last.

    The result does not depend on the partition count. Rows that share all order values
    (a key that a capture repeats) are numbered by the columns ``ties``, then by a hash of
    their other columns.
    Columns: ``df``'s plus ``name``. Actions run here: the checkpoint of the order columns,
    the per-partition row counts and the test for repeated order values.
    """
    order = list(order)
    first, repeated = _numbered(df, order, partitions)
    keys = first.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)], "_at", "_n")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(order)])
    out = df.join(keys, same)
    idx = F.col("_at") + F.lit(start)
    if repeated:
        rest = [c for c in df.columns if c not in order]
        own = Window.partitionBy(*order).orderBy(*[F.col(c).asc_nulls_last() for c in ties], F.xxhash64(*rest) if rest else F.lit(0))
        idx = idx + F.row_number().over(own) - 1
    return out.select(*[F.col(c) for c in df.columns], idx.cast("long").alias(name))


#: Ranges of ``dealt_index`` at most; order values sampled for each; one row in so many is sampled.
RANGES, PER_RANGE, SHARE = 1024, 20, 1024


def _cuts(df: DataFrame, order: list[str]) -> list:
    """Sampled order values (as text) that cut the rows into about even ranges, ascending.

    The sample is taken by a hash of the last order column, which Spark filters below the
    joins that bring the others; where that column has too few values, by a hash of all.
    """
    rows = df.select(*order)
    asc = [F.col(c).asc_nulls_last() for c in order]
    for some in (rows.where(F.pmod(F.xxhash64(order[-1]), F.lit(SHARE)) == 0), rows):
        some = some.orderBy(F.xxhash64(*order)).limit(RANGES * PER_RANGE).distinct().orderBy(*asc)
        with released(df.sparkSession):
            got = some.select(*[F.col(c).cast("string") for c in order]).collect()
        if len(got) >= 3 * PER_RANGE:
            break
    n = min(RANGES, len(got) // PER_RANGE)
    return [got[len(got) * i // n] for i in range(1, n)]


def _with_range(df: DataFrame, order: list[str], cuts: list) -> DataFrame:
    """``df`` with ``_range``: how many cuts are at or below a row's order values (NULLs last).

    A binary search, a projection a step, all of them one generated loop.
    """
    at = {c: F.array(*[F.lit(cut[k]).cast(df.schema[c].dataType) for cut in cuts]) for k, c in enumerate(order)}
    df = df.withColumn("_range", F.lit(0))
    for step in [1 << i for i in reversed(range(len(cuts).bit_length()))]:
        here, low = F.col("_range") + F.lit(step - 1), F.lit(True)
        for c in reversed(order):
            cut, own = F.get(at[c], here), F.col(c)
            below = F.coalesce(cut < own, cut.isNotNull() & own.isNull())
            low = below | (cut.eqNullSafe(own) & low)
        df = df.withColumn("_range", F.when((here < F.lit(len(cuts))) & low, F.col("_range") + F.lit(step)).otherwise(F.col("_range")))
    return df


def dealt_index(df: DataFrame, order, name: str = "index", start: int = 1, ties=(), rest=None, add=None,
                at_rest: bool = False, sample: DataFrame | None = None) -> DataFrame:
    """The numbers of ``global_index`` by one move of the rows.

    The rows are written once with their range of the order values; they are counted there (a
    number a range reaches the driver), go to the ranges and are numbered. ``rest``: the columns
    whose hash numbers rows that share all order values and ``ties`` (default: all others).
    ``add``: a function of the written rows that changes other columns before they move.
    ``at_rest``: ``df`` is read from files and need not be written. ``sample``: the order columns
    of the rows where they take less to make. Actions run here: sample, write and counts.
    """
    order, columns = list(order), df.columns
    rest = [c for c in columns if c not in order] if rest is None else list(rest)
    rows = _with_range(df, order, _cuts(df if sample is None else sample, order))
    # before the texts are packed, and where a reader may leave columns out
    rows = rows.withColumn("_rest", F.xxhash64(*rest)) if rest else rows
    rows = rows if at_rest else sealed(rows, "dealt")
    with released(df.sparkSession):
        counts = {r["_range"]: r["n"] for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [0]
    for k in range(max(counts, default=0)):
        before.append(before[-1] + counts.get(k, 0))
    rows = add(rows) if add else rows
    by = [*order, *ties, *(["_rest"] if rest else [])]
    own = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_last() for c in by])
    number = F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_range")) + F.row_number().over(own) + F.lit(start - 1)
    texts = [c for c, kind in rows.dtypes if kind == "string" and c not in by]
    moved = rows.select("*", pack_texts(texts).alias("_texts")).drop(*texts) if len(texts) > 1 else rows
    moved = moved.withColumn(name, number.cast("long"))
    return moved.withColumns(unpack_texts("_texts", texts) if len(texts) > 1 else {}).select(*columns, name)


def build_key(parts, number, width: int = 3, sep: str = "_") -> Column:
    """``paste(parts..., str_pad(number, width, "left", "0"), sep = sep)``; NULL parts print "NA"."""
    return paste(*parts, pad_int(number, width), sep=sep)
