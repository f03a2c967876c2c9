"""Column profile (codebook) and column labels.

``profile`` summarises every column of a table in a fixed number of passes whatever
the column count: one aggregate for missing counts and native-type min/max, and one
long (column, value) count table -- built with a generator, reduced map-side -- for
distinct counts and modes. Labels live in ``StructField`` metadata, so they travel
with the schema through Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def profile(df: DataFrame, approx: bool = False, quantiles=None, accuracy: int = 10_000) -> DataFrame:
    """One row per column: type, n (rows), n_missing, n_distinct, min, max, mode.

    min/max are taken in the column's own type and shown as text; the mode is the most
    frequent non-NULL value (ties: the smallest text). ``approx=True`` swaps the exact
    distinct count for HyperLogLog and skips the mode (one pass, no value table).
    ``quantiles`` (e.g. ``(0.25, 0.5, 0.75)``) adds ``q<pct>`` text columns for numeric
    columns from ``percentile_approx`` in the same pass: a fixed-size sketch per column
    (rank error about 1/``accuracy``), where exact quantiles would need a sort of every
    column or every value of a column in one task.
    """
    fields = df.schema.fields
    names = [f.name for f in fields]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"m{i}"))
        ordered = isinstance(f.dataType, _ORDERED)
        aggs.append((F.min(c) if ordered else F.lit(None)).cast("string").alias(f"lo{i}"))
        aggs.append((F.max(c) if ordered else F.lit(None)).cast("string").alias(f"hi{i}"))
        if approx:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        for j, q in enumerate(quantiles or ()):
            numeric = isinstance(f.dataType, T.NumericType)
            aggs.append((F.percentile_approx(c, float(q), accuracy) if numeric else F.lit(None))
                        .cast("string").alias(f"q{i}_{j}"))
    one = df.agg(*aggs)
    qnames = [f"q{int(round(q * 100))}" for q in (quantiles or ())]
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(fields[i].dataType.simpleString()).alias("type"),
                 F.col("_rows").alias("n"), F.col(f"m{i}").alias("n_missing"),
                 (F.col(f"d{i}") if approx else F.lit(None).cast("long")).alias("_d"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                 *[F.col(f"q{i}_{j}").alias(qn) for j, qn in enumerate(qnames)])
        for i, n in enumerate(names)]))
    base = one.select(rows.alias("r")).select("r.*")
    if approx:
        return base.withColumnRenamed("_d", "n_distinct").withColumn("mode", F.lit(None).cast("string"))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").cast("string").alias("value")) for n in names
    ])).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    # one row per column (bounded by the schema width, so it may be broadcast)
    per_col = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"),
                                           F.min(F.struct(-F.col("cnt"), "value")).alias("_mode"))
    per_col = per_col.select("column", "n_distinct", F.col("_mode.value").alias("mode"))
    return (base.drop("_d").join(F.broadcast(per_col), "column", "left")
            .select("column", "type", "n", "n_missing", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                    "min", "max", "mode", *qnames))


def with_labels(df: DataFrame, labels: dict) -> DataFrame:
    """Attach ``{column: {"label": ..., "shortDescription": ...}}`` as field metadata."""
    out = df
    for col, meta in labels.items():
        if col in out.columns:
            out = out.withMetadata(col, dict(meta))
    return out


def labels_table(spark, df: DataFrame) -> DataFrame:
    """(column, label, description) read from the schema metadata."""
    rows = [(f.name, f.metadata.get("label"), f.metadata.get("shortDescription")) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, label string, description string")


# Labels of the site product's columns: what a column holds and, where it has one, its unit.
SITE_LABELS = {name: {"shortDescription": text} | ({"label": unit} if unit else {}) for name, text, unit in [
    ("site_id", "Identifies the sampled site", None),
    ("project_code", "Project the sample belongs to", None),
    ("year", "Calendar year of the sample", None),
    ("river", "River sampled", None),
    ("reach", "Reach of the river", None),
    ("pass", "Number of the pass within the project's year", None),
    ("startdatetime", "Start of sampling, local clock", "date and time"),
    ("enddatetime", "End of sampling, local clock", "date and time"),
    ("start_rmi", "Upstream end of the site, counted from the river's mouth", "river miles"),
    ("end_rmi", "Downstream end of the site, counted from the river's mouth", "river miles"),
    ("shoreline", "Bank that was sampled (L, R or B for both)", None),
    ("el_sec", "Electrofishing time", "s"),
    ("boat", "Boat used", None),
    ("crew", "Crew on the boat", None),
    ("site_notes", "Remarks on the site", None),
    ("cond_amb", "Conductivity at the water's own temperature", "\u00b5S/cm"),
    ("cond_spec", "Conductivity converted to 25 \u00b0C", "\u00b5S/cm"),
    ("rvr_temp", "Water temperature in the main channel", "\u00b0C"),
    ("secchi", "Secchi depth in the main channel", "mm"),
    ("water_notes", "Remarks on the water sample", None),
    ("principal", "Who leads the project", None),
    ("agency", "Agency that leads the project", None),
    ("gear_type", "Sampling gear", None),
    ("last_modified", "When the product was written", "date and time"),
]}
