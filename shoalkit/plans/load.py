"""Batch load: proofed tables -> validated, stripped, appended store tables.

The reference appends six tables one after another with no transaction, so a
failure can leave half a batch. Here every table is validated first (keys inside the
batch and against the store, NOT NULL, value lists, non-zero measures, foreign keys to
the batch or the store); the store is appended only when no error-level violation
exists, all tables in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import next_number
from ..operators.integrity import LOAD_ORDER, STORE_RULES, conform, split_rows, union_all, validate_table
from ..operators.projection import drop_matching
from ..session import in_turn, released, sealed, sealed_in_turns, turns
from ..sources import store as store_log
from ..sources.sinks import append_batch

HELPERS = r"_flg$|_index$|^key_"


def read_store_tables(spark: SparkSession, root: str, names=LOAD_ORDER, version: int | None = None) -> dict:
    """The store's tables as of one commit (the last one)."""
    return store_log.read_all(spark, root, version, names)


def next_upload_id(store_site: DataFrame | None) -> int:
    """max(upload_id) + 1 of the store (1 for an empty store); one scalar to the driver."""
    if store_site is None:
        return 1
    return int(next_number(store_site, "upload_id").first()[0])


def assign_upload_id(site: DataFrame, store_site: DataFrame | None) -> DataFrame:
    return site.withColumn("upload_id", F.lit(next_upload_id(store_site)).cast("int"))


def assign_meta_ids(meta: DataFrame, store_meta: DataFrame | None) -> DataFrame:
    """Number new meta rows after the stored ones (an INTEGER PRIMARY KEY loaded as NULL).

    Rows that already carry an id keep it.
    """
    from ..operators.keys import global_index
    start = 1 if store_meta is None else int(next_number(store_meta, "meta_id").first()[0])
    if "meta_id" in meta.columns:
        missing = meta.filter(F.col("meta_id").isNull()).drop("meta_id")
        kept = meta.filter(F.col("meta_id").isNotNull())
    else:
        missing, kept = meta, None
    numbered = global_index(missing, ["year", "project_code"], "meta_id", start=start).withColumn(
        "meta_id", F.col("meta_id").cast("int"))
    return numbered if kept is None else kept.unionByName(numbered, allowMissingColumns=True)


def strip_batch(proofed: dict, upload_id: int) -> dict:
    """Rename, cast and drop helper columns; drop the zero-catch placeholder fish rows."""
    out = {}
    if "meta" in proofed:
        out["meta"] = proofed["meta"]
    if "site" in proofed:
        s = proofed["site"]
        if "project" in s.columns:
            s = s.withColumnRenamed("project", "project_code")
        out["site"] = drop_matching(s.withColumn("upload_id", F.lit(upload_id).cast("int")), HELPERS)
    if "fish" in proofed:
        f = drop_matching(proofed["fish"], HELPERS, "reach")
        out["fish"] = f.filter(F.col("fish_id").isNotNull())
    if "pittag" in proofed:
        p = drop_matching(proofed["pittag"], HELPERS + r"|^site", "species")
        out["pittag"] = p.withColumn("pit_type", F.col("pit_type").cast("string"))
    if "floytag" in proofed:
        out["floytag"] = drop_matching(proofed["floytag"], HELPERS + r"|^site", "species")
    if "water_qual" in proofed:
        out["water_qual"] = proofed["water_qual"].drop("key_a")
    if "vial" in proofed:
        out["vial"] = proofed["vial"]
    return out


def proof_batch(batch: dict, at_rest=()) -> tuple[dict, dict]:
    """(rows that can be loaded, rejected rows) by table, parents before children.

    Each clean table is sealed: its children are held against it. So is each table that is
    not ``at_rest``, as what made it and what splits it move whole rows; a large one is split
    in turns of its keys.
    """
    clean, rejected = {}, {}
    for name in LOAD_ORDER:
        if batch.get(name) is not None:
            df = batch[name] if name in at_rest else sealed(batch[name], name)
            keys = [STORE_RULES[name]["pk"], *STORE_RULES[name].get("unique", [])]
            # one key's rows share a turn; rules over several keys need all rows at once
            n = turns(df.count()) if len(keys) == 1 and all(c in df.columns for c in keys[0]) else 1
            parents = dict(clean)
            clean[name] = sealed_in_turns(lambda k: split_rows(in_turn(df, keys[0], k, n), name, parents)[0], n, name)
            rejected[name] = split_rows(df, name, parents)[1]
    return clean, rejected


def _held_against(spark: SparkSession, root: str, version: int, table: str, df: DataFrame) -> dict:
    """The store's rows that the table's key rules need: files that may hold its keys or its parents'."""
    rule, out = STORE_RULES[table], {}
    asked = [(table, rule["pk"], rule["pk"])] if rule.get("pk") else []
    for cols, ptable, pcols in rule.get("fk", []):
        asked.append((ptable, cols, pcols))
    for name, cols, scols in asked:
        if not all(c in df.columns for c in cols):
            continue
        if scols == STORE_RULES[name].get("pk") and not (name == table and rule.get("unique")):
            keys = df.select(*cols).where(" and ".join(f"{c} is not null" for c in cols))
            with released(spark):
                found = store_log.with_keys(spark, root, name, keys, version)
        else:  # rules over other columns read the whole table (meta: a row a project and year)
            found = store_log.read(spark, root, name, version)
        if found is not None:
            out[name] = found
    return out


def validate_batch(spark: SparkSession, batch: dict, root: str | None = None, version: int = 0) -> DataFrame:
    """Violations of the whole batch, held against itself and the store as of ``version``.

    The tables are checked one after another, so that the disk holds what one table's checks move.
    """
    checks = [sealed(validate_table(spark, name, df, parents=batch,
                                    store=_held_against(spark, root, version, name, df) if version else {}), f"{name}-violations")
              for name, df in batch.items() if df is not None]
    return union_all(checks)


def load_batch(spark: SparkSession, proofed: dict, root: str, write: bool = True,
               conform_tables: bool = False, number_meta: bool = False, attempts: int = 10,
               at_rest=()):
    """Validate the whole batch, then append it in one commit.

    ``number_meta`` gives new meta rows ids after the stored ones; ``conform_tables``
    casts every table to the store schema (columns in order, others dropped; an absent
    column is NULL), without it an absent NOT NULL column refuses the batch. ``at_rest``: the
    tables (names) that are read from files and need not be written before they are checked. Returns
    ``(violations, written_tables, upload_id)``. Nothing is written when any violation has
    severity "error". When another load commits first, the batch gets its ids and is
    validated anew against what the store is then.
    """
    for _ in range(attempts):
        try:
            return _load_once(spark, proofed, root, write, conform_tables, number_meta, at_rest)
        except store_log.Conflict:
            continue
    raise store_log.Conflict(f"{attempts} loads in a row were overtaken")


def _load_once(spark: SparkSession, proofed: dict, root: str, write: bool, conform_tables: bool, number_meta: bool,
               at_rest):
    version = store_log.latest(spark, root)
    held = read_store_tables(spark, root, ["site", "meta"], version) if version else {}
    upload_id = next_upload_id(held.get("site"))
    proofed = dict(proofed)
    if number_meta and "meta" in proofed:
        proofed["meta"] = assign_meta_ids(proofed["meta"], held.get("meta"))
    stripped = strip_batch(proofed, upload_id)
    if conform_tables:
        stripped = {t: conform(df, t) for t, df in stripped.items()}
    # each batch table feeds about ten checks and then the append: compute it once
    batch = {k: v if k in at_rest else sealed(v, k) for k, v in stripped.items()}
    # the report is both the load decision and the return value
    violations = validate_batch(spark, batch, root, version)
    blocked = not violations.filter(F.col("severity") == "error").isEmpty()
    written = append_batch(batch, root, expect=version) if write and not blocked else []
    return violations, written, upload_id
