"""Sinks: CSV products, QC bundles, release bundles, store appends and snapshots.

All writes are distributed (one file per task, no ``coalesce(1)``) and go to shared
storage paths given by the caller; re-running a write replaces only what it owns
(``overwrite`` for products). Store appends and snapshots go through the commit log of
``store``, releases through a manifest of their own.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.integrity import LOAD_ORDER
from . import store
from .files import CSV

#: Sheets and products are many times smaller gzipped; at its fastest level that costs little time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_product(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """CSV with header, NULL written as ``NA``, no row names."""
    # an empty string is written quoted ("") so it reads back as "", not as NULL
    df.write.mode(mode).options(**CSV, **options).csv(path)
    return path


def write_bundle(named: dict, path: str, fmt: str = "csv") -> dict:
    """One folder per named table under ``path`` (the proofing bundle), CSV files gzipped.

    Next to each CSV folder ``<name>`` a one-line ``<name>._schema`` text file keeps the
    table's schema, so the proofed sheet can be read back with its types.
    """
    out = {}
    for name, df in named.items():
        p = f"{path.rstrip('/')}/{name}"
        if fmt == "csv":
            write_product(df, p, **GZIP)
            spark = df.sparkSession
            (spark.createDataFrame([(df.schema.json(),)], "schema string")
             .write.mode("overwrite").text(f"{p}._schema"))
        else:
            df.write.mode("overwrite").parquet(p)
        out[name] = p
    return out


def write_release(named: dict, path: str, project: str, year: int) -> dict:
    """All products of one project x year as gzip CSV, published as a whole.

    Products go to a folder of their own first; the release appears with its manifest,
    ``<path>/<project>_<year>/r<number>.json``, written last by put-if-absent: each product's
    schema, and bytes, rows and MD5 of each file. A later release replaces an earlier one
    for readers (``files.read_release``) and leaves other projects and years alone.
    """
    base, folder = f"{path.rstrip('/')}/{project}_{year}", uuid.uuid4().hex
    out = {name: f"{base}/{folder}/{name}" for name in named}

    def release(name):
        d, p = named[name], out[name]
        spark = d.sparkSession
        if "project_code" not in d.columns:
            d = d.withColumn("project_code", F.lit(project))
        if "year" not in d.columns:
            d = d.withColumn("year", F.lit(year))
        d = d.filter((F.col("project_code") == project) & (F.col("year") == year))
        d.write.options(**CSV, **GZIP).csv(p)
        rows = spark.read.schema(d.schema).options(**CSV).option("multiLine", True).csv(p)
        n = {r["f"]: r["n"] for r in rows.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()}
        return {"product": name, "schema": d.schema.json(), "files": [{**f, "rows": n.get(f["name"], 0)} for f in store.checksums(spark, p, "*.csv.gz")]}

    with ThreadPoolExecutor(max_workers=4) as pool:  # products are written independently of each other
        products = list(pool.map(release, named))
    spark = next(iter(named.values())).sparkSession
    while True:
        number = 1 + max((int(x[1:-5]) for x in store.listing(spark, base) if x.endswith(".json")), default=0)
        if store.put_if_absent(spark, f"{base}/r{number:06d}.json", json.dumps({"folder": folder, "products": products})):
            return out


def append_batch(tables: dict, root: str, source: str | None = None, expect: int | None = None) -> list[str]:
    """Append the tables to the store as one commit (see ``store``); the names written."""
    names = [n for n in LOAD_ORDER if tables.get(n) is not None]
    if names:
        store.append(tables[names[0]].sparkSession, tables, root, source, expect)
    return names


def snapshot_store(spark: SparkSession, root: str, dest: str, date: str, upload_id: int) -> str:
    """Manifest of the store as it is, ``<dest>/<date>_uid-<upload_id>.json``; shares the store's files."""
    return store.snapshot(spark, root, dest, date, upload_id)


# Join key of each store table for co-located (bucketed) layouts: children are bucketed
# on their parent's key, so site -> water/fish and fish -> tags joins need no shuffle.
BUCKET_KEYS = {"site": "site_id", "water_qual": "site_id", "fish": "site_id", "pittag": "fish_id",
               "floytag": "fish_id", "vial": "fish_id"}


def write_bucketed(tables: dict, database: str, buckets: int, mode: str = "append") -> list[str]:
    """Save store tables as catalog tables bucketed and sorted on their join key.

    For deployments with a persistent catalog: two tables bucketed the same way on the
    join key are joined without an exchange on either side. ``buckets`` should keep a
    bucket file near the target file size at full scale.
    """
    written = []
    for name in LOAD_ORDER:
        df = tables.get(name)
        if df is None:
            continue
        w = df.write.mode(mode).format("parquet")
        key = BUCKET_KEYS.get(name)
        if key and key in df.columns:
            w = w.bucketBy(buckets, key).sortBy(key)
        w.saveAsTable(f"{database}.{name}")
        written.append(f"{database}.{name}")
    return written
