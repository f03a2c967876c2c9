"""Registered queries: one Spark callable and one independent DuckDB oracle per key.

Every callable takes ``(spark, sf_dir)``, reads the driver's tables through the
adapter in ``fixtures`` and returns a lazy DataFrame. The oracle text is written
directly in SQL (not generated from the Spark code) over the same adapter prefix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import tables, with_prefix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

YEARS = (1998,)
AS_OF_SQL = "TIMESTAMP '2020-12-31 00:00:00'"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def T(spark, sf_dir):
    return tables(spark, sf_dir)


def W(*names: str) -> str:
    return with_prefix(*names)


def load_all():
    """Import every query module (each registers its keys) and return the registries."""
    from . import (queries_core, queries_etl, queries_integrity, queries_products,  # noqa: F401
                   queries_quality, queries_relational, queries_reports, queries_warehouse)
    return QUERIES, ORACLE
