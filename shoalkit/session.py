"""Session helpers: a tuned local session for tests/bench and the shared scratch folder.

The library itself never builds a session: every operator takes DataFrames from the
caller's session. ``scratch_path`` is the one place that decides where intermediate
tables are written; it reads ``spark.checkpoint.dir`` from the running session (the
shared folder a cluster names) and only falls back to the warehouse folder when that
setting is absent.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark removes a query's shuffle files when the query ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of one turn of a step that moves whole rows several times (see ``sealed_in_turns``).
TURN_ROWS = 64_000_000
_RELEASING, _LOCK, _MADE = Counter(), threading.Lock(), threading.local()


def get_session(master: str | None = None, app: str = "shoalkit",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (local mode). Cluster jobs bring their own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.session.timeZone", "UTC")
         # reliable checkpoints of intermediate layouts are removed once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting one only where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local context
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    if not configured:
        # unset (tests): a folder next to the warehouse, which is shared storage on a cluster
        configured = fallback or (spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
                                  + "/_shoalkit_checkpoints")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/shoalkit/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def released(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind (their results are files or numbers)."""
    key = id(spark)
    with _LOCK:
        _RELEASING[key] += 1
        if _RELEASING[key] == 1:
            _RELEASING[key, "was"] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            _RELEASING[key] -= 1
            if not _RELEASING[key]:
                was = _RELEASING.pop((key, "was"))
                spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)


def sealed(df: DataFrame, name: str = "sealed") -> DataFrame:
    """``df`` written once to the shared scratch folder as Parquet and read back: lineage ends
    here, and a reader takes the columns it needs (a checkpoint holds whole rows, uncompressed)."""
    return sealed_in_turns(lambda _: df, 1, name)


def sealed_in_turns(make, n: int, name: str = "sealed") -> DataFrame:
    """``make(0)`` to ``make(n - 1)`` written one after another to one folder and read back.

    The shuffle files of a turn go before the next begins, so that the disk holds what
    one turn moves (``turns``, ``in_turn``), and the rows.
    """
    for k in range(n):
        df = make(k)
        if not k:
            spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
            for paths in getattr(_MADE, "paths", []):
                paths.append(path)
        with released(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make, name: str = "settled") -> DataFrame:
    """``make()`` sealed, and the tables that were sealed on the way to it removed.

    ``make`` keeps no table that it seals for later use.
    """
    _MADE.paths = [*getattr(_MADE, "paths", []), []]
    try:
        df = make()
    finally:
        *_MADE.paths, paths = _MADE.paths
    out, spark = sealed(df, name), df.sparkSession
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out


def turns(rows: int) -> int:
    """Turns for a step over so many rows."""
    return max(1, -(-rows // TURN_ROWS))


def in_turn(df: DataFrame, cols, k: int, n: int) -> DataFrame:
    """The rows of turn ``k`` of ``n``; rows with equal values in ``cols`` (NULLs, too) share one."""
    return df if n == 1 else df.where(F.pmod(F.xxhash64(*cols), F.lit(n)) == k)
