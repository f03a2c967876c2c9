"""Landed daily-value text of gauging stations: tab-separated sections with headers of their own.

A file holds comments (``#``) and sections. A section begins with its column names
(``agency_cd``, ``site_no``, ``datetime`` and, for each series, ``<series>_<parameter>_<statistic>``
with its marks in a column of that name and ``_cd``) and a line of column widths; its rows
are days. Parameter and statistic of a value stand in its column's name only, and sections
of one file may have different series. Files are read whole, each by one task (a station's
file is small), and cut with built-in functions; no schema is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SERIES = r"^(.+)_(\d{5})_(\d{5})$"


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """One row per station, day and series: staid, date, code, stat, val, qualcode, series, value.

    ``val`` is NULL where the value is a mark (such as ``Ice`` or ``Eqp``), which ``value`` keeps; a
    day whose cell and mark of a series are empty or missing has no row of it.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "\r", "").alias("text"))
    # a section starts where a line of column names does
    sections = files.select(F.explode(F.split("text", r"(?m)^(?=agency_cd\t)")).alias("s")).filter(F.col("s").startswith("agency_cd\t"))
    lines = sections.select(F.filter(F.split("s", "\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#")).alias("l"))
    rows = lines.select(F.split(F.get("l", F.lit(0)), "\t").alias("names"), F.explode(F.slice("l", F.lit(3), F.greatest(F.size("l") - 2, F.lit(0)))).alias("row"))
    cells = F.split("row", "\t", -1)
    rows = rows.select("names", F.transform("names", lambda _, i: F.get(cells, i)).alias("cells"))
    at = lambda name: F.get("cells", F.array_position("names", name).cast("int") - 1)
    series = F.filter(F.arrays_zip("names", "cells"), lambda x: x["names"].rlike(_SERIES))
    marks = F.map_from_arrays("names", "cells")
    d = rows.select(at("site_no").alias("staid"), F.try_to_date(F.substring(at("datetime"), 1, 10)).alias("date"), marks.alias("m"), F.explode(series).alias("x"))
    value = F.nullif(F.trim("x.cells"), F.lit(""))
    out = d.select("staid", "date", F.regexp_extract("x.names", _SERIES, 2).alias("code"), F.regexp_extract("x.names", _SERIES, 3).alias("stat"),
                    value.try_cast("double").alias("val"), F.nullif(F.try_element_at("m", F.concat("x.names", F.lit("_cd"))), F.lit("")).alias("qualcode"),
                    F.regexp_extract("x.names", _SERIES, 1).alias("series"), value.alias("value"))
    return out.filter("value is not null or qualcode is not null")


def write_daily(daily: DataFrame, path: str) -> str:
    """Land daily values (staid, date, code, stat, val, qualcode: one row each) as such text.

    A station's year is a section, with the series it has; at most 366 lines a group.
    """
    name = F.concat_ws("_", F.lit("85"), "code", "stat")
    d = daily.select("staid", F.year("date").alias("y"), F.col("date").cast("string").alias("day"), name.alias("name"),
                     F.coalesce(F.col("val").cast("string"), F.lit("")).alias("v"), F.coalesce("qualcode", F.lit("")).alias("q"))
    days = d.groupBy("staid", "y", "day").agg(F.collect_list(F.struct("name", F.struct("v", "q").alias("c"))).alias("m"))
    year = days.groupBy("staid", "y").agg(F.sort_array(F.collect_list(F.struct("day", "m"))).alias("days"),
                                          F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.col("m.name"))))).alias("names"))
    tab = lambda *parts: F.concat_ws("\t", *parts)
    head = tab(F.lit("agency_cd"), F.lit("site_no"), F.lit("datetime"), F.concat_ws("\t", F.transform("names", lambda n: tab(n, F.concat(n, F.lit("_cd"))))))
    widths = tab(F.lit("5s"), F.lit("15s"), F.lit("20d"), F.concat_ws("\t", F.transform("names", lambda n: F.lit("14n\t10s"))))
    of = lambda day, n: F.try_element_at(F.map_from_entries(day["m"]), n)
    cell = lambda day: F.concat_ws("\t", F.transform("names", lambda n: tab(*[F.coalesce(of(day, n)[x], F.lit("")) for x in "vq"])))
    body = F.concat_ws("\n", F.transform("days", lambda day: tab(F.lit("USGS"), F.col("staid"), day["day"], cell(day))))
    text = F.concat_ws("\n", F.concat(F.lit("# daily values of station "), F.col("staid")), head, widths, body)
    year.select(text.alias("text")).write.text(path)
    return path
