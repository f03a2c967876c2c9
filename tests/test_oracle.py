"""Every registered query against its independent DuckDB SQL (row count, names, values)."""

import re

import pytest

import __spark_entry__ as entry
from tools.oracle_check import digest

from .conftest import SF_SMALL

CORPUS = re.compile(r"op\d+_|pipeline$")  # the optional subpackage tests its own queries
KEYS = sorted(k for k in entry.oracle_sql() if not CORPUS.match(k))


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = {k for k in entry.queries() if not CORPUS.match(k)} - set(entry.oracle_sql())
    assert no_oracle == set(), no_oracle


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "cpue" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = entry.queries()[key](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL, entry.oracle_sql()[key])
    c1, r1, h1 = digest(got)
    c2, r2, h2 = digest(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert h1 == h2, (sorted(set(r1) - set(r2))[:3], sorted(set(r2) - set(r1))[:3])
