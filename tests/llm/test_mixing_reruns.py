"""Sums of the mix do not depend on the order of its rows, so reruns agree to the last digit."""

from pyspark.sql import functions as F

from shoalkit.llm import mixing


def test_sums_do_not_depend_on_row_order(spark):
    rows = spark.range(3000, numPartitions=1).select((F.exp(F.col("id") % 37 / 7.3) * (F.col("id") + 1) / 3).alias("x"), "id")
    up, down = (rows.orderBy(o).coalesce(1).agg(mixing._exact_sum(F.col("x"))).first()[0] for o in (F.asc("id"), F.desc("id")))
    assert up == down and abs(up / rows.agg(F.sum("x")).first()[0] - 1) < 1e-12
