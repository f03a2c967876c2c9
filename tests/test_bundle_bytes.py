"""A bundle's sheets are gzipped, and read back by value as plain ones are."""

from pathlib import Path

from pyspark.sql import functions as F

from shoalkit.session import scratch_path
from shoalkit.sources import files, sinks


def test_sheets_are_gzipped_and_lose_nothing(spark):
    sheet = spark.range(3000).select(
        F.col("id"), F.concat(F.lit("S"), F.col("id") % 40).alias("site_id"),
        F.expr("CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a \"b\"\nc' ELSE ' x ' END").alias("notes"),
        F.when(F.col("id") % 3 == 0, "FLAG").otherwise("").alias("rmi_flg"), F.lit("").alias("orphan_flg"))
    path = scratch_path(spark, "test-bundle")
    folder = sinks.write_bundle({"s": sheet}, path)["s"]
    plain = sinks.write_product(sheet, scratch_path(spark, "test-plain"))

    def size(p):
        parts = list(Path(p.removeprefix("file:")).glob("part-*"))
        return [x.name for x in parts], sum(x.stat().st_size for x in parts)

    names, packed = size(folder)
    assert all(n.endswith(".csv.gz") for n in names) and packed * 3 < size(plain)[1]
    assert all(n.endswith(".csv") for n in size(plain)[0])
    # a sheet that came back from proofing as plain CSV is read the same way
    for got in (files.read_bundle_sheet(spark, path, "s"), files.read_sheet(spark, plain, "", sheet.schema)):
        assert got.dtypes == sheet.dtypes
        assert sorted(got.collect(), key=lambda r: r["id"]) == sorted(sheet.collect(), key=lambda r: r["id"])
