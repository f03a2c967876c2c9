"""Capture files are decoded in blocks that do not grow with the file."""

from pyspark.sql import functions as F

from shoalkit.sources import dbf


def test_dbf_records_are_decoded_in_blocks(spark, tmp_path, monkeypatch):
    df = spark.range(1000).selectExpr("cast(id as int) AS n", "concat('x', id) AS c")
    path = dbf.write_dbf(df.coalesce(1), str(tmp_path), "t")
    monkeypatch.setattr(dbf, "BLOCK", 700)
    source = dbf.DbfDataSource({"path": path})
    reader = source.reader(source.schema())
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(batches) > 5 and max(b.nbytes for b in batches) < 5000
    assert [n for b in batches for n in b.column(0).to_pylist()] == list(range(1000))
    assert df.exceptAll(dbf.read_dbf(spark, path).select(F.col("n"), F.col("c"))).count() == 0
