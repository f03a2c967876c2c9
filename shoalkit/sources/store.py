"""The survey store: batches of Parquet files behind a log of commits.

A load writes the files of all its tables first, each table into a folder of its own
(``data/<table>/batch=<token>``), and then one manifest, ``commits/<number>.json``, by
put-if-absent. Readers take only what manifests name, so a load that dies between two
tables leaves nothing readable, and a batch appears as a whole. Two loads at once race for
one number: the loser sees the winner's commit, validates against it again and retries.

A manifest names each file with its bytes, rows, MD5 and the smallest and largest primary
key, and each table's schema. Snapshots are manifests, too: they name the store's files and
copy none; ``vacuum`` removes only folders that neither commits nor snapshots name.

A key index is written beside the files (``keys/<table>/batch=<token>``): a Bloom filter a
file, one 64-bit word a row, a key's bits all in one word, so that a test is an equi-join on
(file, word). ``with_keys`` reads only files whose key range and filter may hold one of the
keys asked for; who joins the result on the key gets the exact answer.

The put-if-absent step is atomic on HDFS-like file systems (rename to an absent name) and on
local ones (hard link); an object store needs a file system with conditional writes.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.integrity import LOAD_ORDER, STORE_RULES
from ..operators.sketch import column_states, merge_states, read_states

#: Filter bits per key and file; ranges the keys asked for are grouped into.
BITS, RANGES = 12, 64
#: What a batch writes for a table: its rows, key index and column states.
BESIDE = ("data", "keys", "states")
FILES = "name string, bytes long, rows long, md5 string, low string, high string"
MANIFEST = f"version long, source string, tables array<struct<`table`:string,path:string,schema:string,bits:int,sketched:boolean,files:array<struct<{FILES}>>>>"


class Conflict(RuntimeError):
    """Another load was committed first; validate against it and try again."""


# ---- the file system, asked through the session ----

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False where the name is taken."""
    fs, target = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: spark._jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
            spark._jvm.java.nio.file.Files.createLink(local(target), local(part))
        else:
            how = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context = spark._jvm.org.apache.hadoop.fs.FileContext
            context.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()).rename(part, target, how)
    except Exception as e:  # py4j wraps what Java raises
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    finally:
        fs.delete(part, False)
    return True


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ---- the log ----

def latest(spark: SparkSession, root: str) -> int:
    """Number of the last commit, 0 for an empty store."""
    return max((int(n[:-5]) for n in listing(spark, f"{root.rstrip('/')}/commits") if n.endswith(".json")), default=0)


def manifests(spark: SparkSession, root: str, version: int | None = None) -> list:
    """Manifests up to ``version``, in order."""
    version = latest(spark, root) if version is None else version
    if not version:
        return []
    paths = [f"{root.rstrip('/')}/commits/{n:012d}.json" for n in range(1, version + 1)]
    return sorted(spark.read.schema(MANIFEST).json(paths).collect(), key=lambda m: m["version"])


def _named(found: list, table: str) -> list:
    return [t for m in found for t in m["tables"] if t["table"] == table]


def _schema(entries: list) -> StructType:
    """The newest entry's columns, then those that only older ones have."""
    out, names = StructType(), set()
    for e in reversed(entries):
        for f in StructType.fromJson(json.loads(e["schema"])).fields:
            if f.name not in names:
                out.add(f)
                names.add(f.name)
    return out


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame | None:
    """A table as of a commit (the last one); None where no commit names it."""
    entries = _named(manifests(spark, root, version), table)
    if not entries:
        return None
    return spark.read.schema(_schema(entries)).parquet(*[f"{root.rstrip('/')}/{e['path']}" for e in entries])


def read_all(spark: SparkSession, root: str, version: int | None = None, names=LOAD_ORDER) -> dict:
    """The store's tables by name, all as of one commit."""
    version = latest(spark, root) if version is None else version
    out = {n: read(spark, root, n, version) for n in names}
    return {n: df for n, df in out.items() if df is not None}


# ---- loads ----

def key_text(cols) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def _primary(table: str, columns) -> list[str]:
    key = STORE_RULES.get(table, {}).get("pk", [])
    return key if all(c in columns for c in key) else []


def _word(key: Column, bits: int) -> tuple[Column, Column]:
    """A key's word in a filter of 2^bits words, and the four bits it sets there."""
    h = F.xxhash64(key)
    one = F.lit(1).cast("long")
    each = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), each)
    return F.shiftrightunsigned(h, 24).bitwiseAND(F.lit((1 << bits) - 1)), mask


def checksums(spark: SparkSession, folder: str, pattern: str) -> list[dict]:
    """Name, bytes and MD5 of a folder's files, read where executors are."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    raw = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    return sorted((r.asDict() for r in raw.collect()), key=lambda f: f["name"])


def stage(spark: SparkSession, df: DataFrame, root: str, table: str, token: str, sketch: bool = False) -> dict:
    """Write a table's files, key index and (if asked for) column states; the manifest's entry for them."""
    root, path = root.rstrip("/"), f"data/{table}/batch={token}"
    df.write.parquet(f"{root}/{path}")
    files = {f["name"]: {**f, "rows": 0, "low": None, "high": None} for f in checksums(spark, f"{root}/{path}", "*.parquet")}
    key, bits = _primary(table, df.columns), 0
    got = spark.read.schema(df.schema).parquet(f"{root}/{path}").select(F.col("_metadata.file_name").alias("name"), (key_text(key) if key else F.lit("")).alias("key"))
    for r in got.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")).collect():
        files[r["name"]] |= {"rows": r["rows"], "low": r["low"] if key else None, "high": r["high"] if key else None}
    if key:
        most = max((f["rows"] for f in files.values()), default=0)
        bits = max(0, (most * BITS // 64).bit_length())
        word, mask = _word(F.col("key"), bits)
        index = got.select("name", word.alias("word"), mask.alias("mask")).groupBy("name", "word").agg(F.bit_or("mask").alias("bits"))
        index.write.parquet(f"{root}/keys/{table}/batch={token}")
    if sketch:
        column_states(spark.read.schema(df.schema).parquet(f"{root}/{path}")).write.parquet(f"{root}/states/{table}/batch={token}")
    return {"table": table, "path": path, "schema": df.schema.json(), "bits": bits, "sketched": sketch, "files": sorted(files.values(), key=lambda f: f["name"])}


def commit(spark: SparkSession, root: str, entries: list[dict], source: str | None = None, expect: int | None = None) -> int:
    """Make staged tables readable as one batch. ``expect``: the commit they were validated
    against; raises ``Conflict`` where another came after it, else tries the next number.
    A ``source`` that a commit already names is not committed again (its number returns)."""
    while True:
        last = latest(spark, root)
        if source is not None:
            for m in manifests(spark, root, last):
                if m["source"] == source:
                    return m["version"]
        if expect is not None and last != expect:
            raise Conflict(f"commit {last} came after {expect}")
        manifest = json.dumps({"version": last + 1, "source": source, "tables": entries})
        if put_if_absent(spark, f"{root.rstrip('/')}/commits/{last + 1:012d}.json", manifest):
            return last + 1


def append(spark: SparkSession, tables: dict, root: str, source: str | None = None, expect: int | None = None,
           sketch: bool = False) -> int:
    """Load tables as one batch; the commit's number. ``sketch``: keep
    each table's column states beside its files (see ``profile``)."""
    if source is not None:
        for m in manifests(spark, root):
            if m["source"] == source:
                return m["version"]
    token = uuid.uuid4().hex
    names = [n for n in LOAD_ORDER if tables.get(n) is not None]
    try:
        with ThreadPoolExecutor(max_workers=4) as pool:  # tables are staged independently of each other
            entries = list(pool.map(lambda n: stage(spark, tables[n], root, n, token, sketch), names))
        return commit(spark, root, entries, source, expect)
    except Conflict:
        for n in names:
            for kind in BESIDE:
                _remove(spark, f"{root.rstrip('/')}/{kind}/{n}/batch={token}")
        raise


def profile(spark: SparkSession, root: str, table: str, quantiles=(0.25, 0.5, 0.75), version: int | None = None) -> DataFrame | None:
    """Column profile of a stored table from the states of its batches; only rows of batches
    that were loaded without states are read."""
    entries = _named(manifests(spark, root, version), table)
    root, states = root.rstrip("/"), []
    if with_ := [f"{root}/states/{table}/{e['path'].rsplit('/', 1)[1]}" for e in entries if e["sketched"]]:
        states.append(spark.read.parquet(*with_))
    states += [column_states(spark.read.schema(_schema([e])).parquet(f"{root}/{e['path']}")) for e in entries if not e["sketched"]]
    return read_states(merge_states(reduce(DataFrame.unionByName, states)), quantiles) if states else None


# ---- the key index ----

def with_keys(spark: SparkSession, root: str, table: str, keys: DataFrame, version: int | None = None) -> DataFrame | None:
    """The store's rows in files that may hold one of ``keys`` (one column per primary-key
    column, in order): no file that holds one is left out. None where the table has no rows."""
    entries = _named(manifests(spark, root, version), table)
    if not entries:
        return None
    schema, root = _schema(entries), root.rstrip("/")
    nothing = spark.createDataFrame([], schema)
    asked = keys.select(key_text(keys.columns).alias("key"))
    ranges = _ranges(asked)
    if not ranges:
        return nothing
    # what the key ranges leave, on the driver as any listing of files: the (entry, file) of each range
    ends, held = [hi for _, hi in ranges], [[] for _ in ranges]
    for k, e in enumerate(entries):
        for f in e["files"]:
            if f["rows"]:
                for i in range(bisect_left(ends, f["low"]), len(ranges)):
                    if ranges[i][0] > f["high"]:
                        break
                    held[i].append((k, f["name"]))
    groups = sorted({tuple(h) for h in held if h})  # ranges that ask the same files are one group
    if not groups:
        return nothing
    cut = spark.createDataFrame([(lo, hi, groups.index(tuple(h))) for (lo, hi), h in zip(ranges, held) if h], "r_low string, r_high string, g int")
    hits = []
    for bits in sorted({e["bits"] for e in entries}):
        left = [(g, k, name) for g, files in enumerate(groups) for k, name in files if entries[k]["bits"] == bits]
        if left:
            own = sorted({f"{root}/keys/{table}/{entries[k]['path'].rsplit('/', 1)[1]}" for _, k, _ in left})
            index = spark.read.schema("name string, word long, bits long").parquet(*own).select(F.col("name").alias("i_name"), F.col("word").alias("i_word"), F.col("bits").alias("i_bits"))
            files = spark.createDataFrame(left, "f_g int, entry int, name string")
            index = index.join(F.broadcast(files), F.col("i_name") == F.col("name"))
            hit = _asked_words(asked, cut, bits).join(index, (F.col("g") == F.col("f_g")) & (F.col("word") == F.col("i_word")) & (F.col("i_bits").bitwiseAND(F.col("mask")) == F.col("mask")))
            hits.append(hit.select("entry", "name").distinct())
    found = sorted(map(tuple, reduce(DataFrame.unionByName, hits).distinct().collect()))
    return spark.read.schema(schema).parquet(*[f"{root}/{entries[k]['path']}/{name}" for k, name in found]) if found else nothing


def _asked_words(asked: DataFrame, cut: DataFrame, bits: int) -> DataFrame:
    """(group, word, mask) of each key asked for: one narrow row a key, however many files may hold it."""
    word, mask = _word(F.col("key"), bits)
    inside = (F.col("key") >= F.col("r_low")) & (F.col("key") <= F.col("r_high"))  # RANGES rows
    return asked.join(F.broadcast(cut), inside).select("g", word.alias("word"), mask.alias("mask"))


def _ranges(keys: DataFrame) -> list[tuple[str, str]]:
    """At most ``RANGES`` ranges, ascending and apart, that cover all keys, cut where a sample's are wide.

    No key moves: each pass reduces the keys where they are read, and only the sample is made distinct.
    """
    ends = keys.agg(F.min("key").alias("a"), F.max("key").alias("b"), F.approx_count_distinct("key").alias("n")).first()
    if ends["a"] is None:
        return []
    share = max(1, ends["n"] // (20 * RANGES))
    ranked = keys.where(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).distinct().orderBy(F.xxhash64("key")).limit(20 * RANGES)
    some = sorted({r["key"] for r in ranked.collect()} | {ends["a"], ends["b"]})
    cuts = sorted({some[len(some) * i // RANGES] for i in range(1, RANGES)})
    part = F.lit(0)
    for c in cuts:
        part = part + (F.col("key") >= c).cast("int")
    got = keys.where("key is not null").groupBy(part.alias("p")).agg(F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
    return sorted((r["lo"], r["hi"]) for r in got)


# ---- snapshots and cleaning ----

def snapshot(spark: SparkSession, root: str, dest: str, date: str, upload_id: int, version: int | None = None) -> str:
    """A manifest of the store as of a commit, ``<dest>/<date>_uid-<upload_id>.json``; no file is copied."""
    version = latest(spark, root) if version is None else version
    tables = [t.asDict(recursive=True) for m in manifests(spark, root, version) for t in m["tables"]]
    fs, p = _fs(spark, root)
    path = f"{dest.rstrip('/')}/{date}_uid-{upload_id}.json"
    text = json.dumps({"version": version, "source": fs.makeQualified(p).toString(), "tables": tables})
    if not put_if_absent(spark, path, text):
        raise FileExistsError(path)
    return path


def read_snapshot(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A table as the snapshot names it, whatever was loaded since."""
    m = spark.read.schema(MANIFEST).json(path).first()
    entries = _named([m], table)
    names = [f"{m['source']}/{e['path']}/{f['name']}" for e in entries for f in e["files"]]
    return spark.read.schema(_schema(entries)).parquet(*names) if names else None


def damaged(spark: SparkSession, path: str) -> DataFrame:
    """Files of a snapshot that are absent or differ from what it says: (name, said, found)."""
    m = spark.read.schema(MANIFEST).json(path).first()
    said = [(f"{e['path']}/{f['name']}", f["md5"]) for e in m["tables"] for f in e["files"]]
    have = spark.createDataFrame(said, "name string, said string")
    there = [f"{m['source']}/{p}" for p in sorted({n.rsplit("/", 1)[0] for n, _ in said}) if listing(spark, f"{m['source']}/{p}")]
    if not there:
        return have.withColumn("found", F.lit(None).cast("string"))
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(there)
    found = found.select(F.concat_ws("/", F.slice(F.split("path", "/"), -4, 4)).alias("name"), F.md5("content").alias("found"))
    return have.join(found, "name", "left").where(~F.col("said").eqNullSafe(F.col("found")))


def vacuum(spark: SparkSession, root: str, snapshots: list[str] = (), keep: set[str] = frozenset()) -> list[str]:
    """Remove folders of loads that never were committed, and return them. ``keep``: batch
    folders of loads still running; files that a snapshot names stay in any case."""
    root = root.rstrip("/")
    named = {t["path"] for m in manifests(spark, root) for t in m["tables"]}
    for s in snapshots:
        named |= {t["path"] for t in spark.read.schema(MANIFEST).json(s).first()["tables"]}
    gone = []
    for table in listing(spark, f"{root}/data"):
        for batch in listing(spark, f"{root}/data/{table}"):
            path = f"data/{table}/{batch}"
            if path not in named and batch not in keep:
                for kind in BESIDE:
                    _remove(spark, f"{root}/{kind}/{table}/{batch}")
                gone.append(path)
    return gone
