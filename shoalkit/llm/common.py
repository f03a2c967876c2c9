"""Helpers shared by the corpus operators: table access, scratch tables, text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalkit.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here and
    a lost executor costs a file read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Rows no classifier learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most about ``limit`` rows, picked by a hash of ``key`` so reruns agree.

    The count comes first, so the kept share falls as the table grows and the sample's
    size does not; all rows stay when there are no more than ``limit``.
    """
    n = df.count()
    if n <= limit:
        return df
    share = limit / n
    u = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return df.where(u < F.lit(share))


def whole_vectors(df: DataFrame, column: str, factor: int, name: str = "v") -> DataFrame:
    """Rows of ``df`` whose vector has neither null nor non-finite components, with
    floor(factor * component) of each as longs (held at the ends of their range)."""
    x = F.col(column)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(x.isNotNull() & ~bad).withColumn(name, F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(factor)))))
