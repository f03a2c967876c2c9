"""Files keep every value, or the writer says that it cannot."""

import pytest
from pyspark.sql import functions as F

from shoalkit.session import scratch_path
from shoalkit.sources import dbf, files, sinks


def test_dbf_round_trip_is_exact(spark, tmp_path):
    rows = [(123456789012345677, "é x", -109.12345678901234), (None, None, None), (-5, "y", 0.1)]
    df = spark.createDataFrame(rows, "n long, t string, x double").withColumn("d", F.to_date(F.lit("2020-02-29")))
    got = dbf.read_dbf(spark, dbf.write_dbf(df, str(tmp_path), "all"))
    key = lambda r: str(r)
    assert sorted(map(tuple, got.select("n", "t", "x", "d").collect()), key=key) == sorted(map(tuple, df.collect()), key=key)


@pytest.mark.parametrize("value,kind,name", [("x" * 255, "string", "t"), ("Łódź", "string", "t"), (1, "long", "effort_minutes"),
                                             (-123456789012345678, "long", "n"), (1e300, "double", "x")])
def test_dbf_writer_refuses_what_does_not_fit(spark, tmp_path, value, kind, name):
    with pytest.raises(Exception, match="fit|10 characters|encode"):
        dbf.write_dbf(spark.createDataFrame([(value,)], f"`{name}` {kind}"), str(tmp_path), "bad")


def test_sheet_keeps_blanks_newlines_quotes_and_microseconds(spark):
    rows = [(1, " a "), (2, 'line\nbreak, "quoted"'), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "k int, note string").withColumn("at", F.to_timestamp_ntz(F.lit("2020-07-01 08:00:00.123456")))
    path = scratch_path(spark, "test-bundle")
    sinks.write_bundle({"s": df}, path)
    assert sorted(map(tuple, files.read_bundle_sheet(spark, path, "s").collect())) == sorted(map(tuple, df.collect()))
