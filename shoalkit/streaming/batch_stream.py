"""Incremental batch loading with Structured Streaming.

Proofed files land in a folder; an ``availableNow`` stream picks up what is new since
the last run (the stream checkpoint remembers which files were taken), validates each
micro-batch with the store rules and appends clean batches to the store. A micro-batch is
one commit of the store's log that names its stream and number as source, so a replayed
batch finds itself committed and is not loaded twice, and streams and plain loads share one
layout; batches with error-level violations go to a violations table instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import integrity as ck
from ..sources import store as log


def _writer(spark: SparkSession, table: str, store_root: str, rules: dict | None, stream: str):
    bad_path = f"{store_root.rstrip('/')}/violations/{table}"

    def handle(batch: DataFrame, batch_id: int):
        source = f"{stream}#{batch_id}"
        while True:
            version = log.latest(spark, store_root)
            if any(m["source"] == source for m in log.manifests(spark, store_root, version)):
                return  # a replayed batch is there already
            held = log.read(spark, store_root, table, version)
            v = ck.validate_table(spark, table, batch, store={} if held is None else {table: held}, rules=rules)
            errors = v.filter(F.col("severity") == "error")
            if not errors.isEmpty():
                (errors.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(bad_path))
                return
            try:
                log.append(spark, {table: batch}, store_root, source, expect=version)
                return
            except log.Conflict:  # another load came first: hold the batch against it, too
                continue

    return handle


def load_stream(spark: SparkSession, landing: str, table: str, schema, store_root: str,
                checkpoint: str, rules: dict | None = None, max_files: int | None = None):
    """Run one ``availableNow`` pass over ``landing`` and return the finished query."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(landing)
    q = (stream.writeStream.foreachBatch(_writer(spark, table, store_root, rules, checkpoint))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
