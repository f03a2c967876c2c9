"""File and store sources: table families, store tables, sheets, CSV, landed daily values.

Every reader returns a lazy DataFrame with an explicit schema where one is known, so
no inference pass runs over 100 TB and Parquet scans keep filter/column pushdown.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its own file system.

    An absent table is a normal case; one that cannot be read must fail, so callers test
    for existence instead of catching what a read raises.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


STORE_TABLES = ("meta", "site", "water_qual", "fish", "pittag", "floytag", "vial")


def union_family(tables: dict, family: str) -> DataFrame | None:
    """Stack every table whose name contains ``family`` (a regex), by column name.

    Missing columns become NULL (``bind_rows``). Empty inputs are kept out. Returns
    None when no table matches.
    """
    pat = re.compile(family)
    picked = [df for name, df in tables.items() if pat.search(name)]
    if not picked:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), picked)


def read_store(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """One store table as of a commit (the last one); fails where no commit names it."""
    from .store import read
    df = read(spark, root, table, version)
    if df is None:
        raise ValueError(f"{root} has no table {table}")
    return df


def read_warehouse(spark: SparkSession, source: str, table: str, columns=None, properties: dict | None = None,
                   partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """One table of the normalised warehouse, with the column projection to use.

    ``source`` is a JDBC URL (``jdbc:...``; read in ``num_partitions`` parallel ranges of
    ``partition_column`` when given -- needs a driver on the classpath and a reachable
    server) or a folder of landed extracts (``<source>/<table>`` Parquet). ``columns``
    is a list of names or a ``{new_name: column}`` mapping (rename while projecting).
    """
    if source.startswith("jdbc:"):
        r = spark.read.format("jdbc").option("url", source).option("dbtable", table)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
                 .option("upperBound", upper).option("numPartitions", num_partitions))
        df = r.load()
    else:
        df = spark.read.parquet(f"{source.rstrip('/')}/{table}")
    if columns is None:
        return df
    if isinstance(columns, dict):
        return df.select(*[F.col(old).alias(new) for new, old in columns.items()])
    return df.select(*columns)


#: CSV options shared by writers and readers: blanks and microseconds are kept.
CSV = {"header": True, "nullValue": "NA", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
       "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "escape": '"'}


def read_sheet(spark: SparkSession, bundle: str, sheet: str, schema) -> DataFrame:
    """One proofed sheet of a bundle (``<bundle>/<sheet>`` CSV folder) with its schema.

    "NA" cells read as NULL, as the bundle writer stores them.
    """
    return (spark.read.schema(schema).options(**CSV).option("multiLine", True)
            .option("mode", "FAILFAST").csv(f"{bundle.rstrip('/')}/{sheet}"))


def read_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """CSV with header; types inferred (one extra pass) unless ``infer`` is False."""
    return spark.read.options(**CSV).option("multiLine", True).option("inferSchema", infer).csv(path)


def read_bundle_sheet(spark: SparkSession, bundle: str, sheet: str) -> DataFrame:
    """A sheet of a bundle written by ``write_bundle``, with the schema stored beside it."""
    from pyspark.sql.types import StructType
    import json
    p = f"{bundle.rstrip('/')}/{sheet}"
    schema = StructType.fromJson(json.loads(spark.read.text(f"{p}._schema").first()[0]))
    return read_sheet(spark, bundle, sheet, schema)


def read_release(spark: SparkSession, path: str, project: str, year: int, product: str) -> DataFrame:
    """A product of the last release of a project x year, refused where a file differs from the manifest."""
    from pyspark.sql.types import StructType
    import json
    from . import store
    base = f"{path.rstrip('/')}/{project}_{year}"
    numbers = [n for n in store.listing(spark, base) if n.endswith(".json")]
    if not numbers:
        raise FileNotFoundError(f"{base} has no release")
    release = json.loads(spark.read.text(f"{base}/{numbers[-1]}", wholetext=True).first()[0])
    entry = next(p for p in release["products"] if p["product"] == product)
    folder = f"{base}/{release['folder']}/{product}"
    said = {f["name"]: (f["bytes"], f["md5"]) for f in entry["files"]}
    found = {f["name"]: (f["bytes"], f["md5"]) for f in store.checksums(spark, folder, "*.csv.gz")}
    if said != found:
        raise ValueError(f"{folder} is not what was released: {sorted(n for n in said.keys() | found.keys() if said.get(n) != found.get(n))}")
    return read_sheet(spark, folder, "", StructType.fromJson(json.loads(entry["schema"])))
