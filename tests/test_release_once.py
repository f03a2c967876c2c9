"""The products of snk_release_bundle are computed once, for both of its releases (F8)."""

from datetime import datetime

import pytest

from shoalkit import catalog
from shoalkit.sources import sinks


@pytest.fixture
def tables_dir(spark, tmp_path):
    at = datetime(1998, 6, 1)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "GR")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(1, "a", 0, 1.0, "HOUSEHOLD"), (2, "b", 0, 1.0, "BUILDING")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(k, 1 + (k > 9), "O", 1000.0 * k, at, "1-URGENT") for k in range(1, 15)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(k, 11 * k, k, n, 5.0, 900.0, 0.0, 0.0, "RAN"[n % 3], "F", at) for k in range(1, 15) for n in range(4)]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
                   [(k, datetime(2024, 3, 1), k, ("view", "click")[k % 2], 1.0 * k, "{}") for k in range(8)]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_both_releases_take_products_that_were_computed_once(spark, tables_dir, monkeypatch):
    calls, write = [], sinks.write_release

    def seen(named, *a):
        calls.append({n: df._jdf.queryExecution().optimizedPlan().toString() for n, df in named.items()})
        return write(named, *a)

    monkeypatch.setattr(sinks, "write_release", seen)
    got = catalog.load_all()[0]["snk_release_bundle"](spark, tables_dir)
    n = {r["product"]: r["count"] for r in got.groupBy("product").count().collect()}
    # 9 sites of the project in 1998; species SM only (part keys are 0 modulo 11): 4 stages or fewer
    assert n["site"] == 9 and n["fish"] == 36 and n["cpue"] == 9 and n["floy"] == 14 and n["cpue_ls"] == 9 and n["usgswater"] > 0
    assert len(calls) == 2
    for plans in calls:
        assert not {p for p, plan in plans.items() if "Join" in plan or "Aggregate" in plan}
