"""Steps whose moved and held bytes grow with the input alone; tables build their own rows."""

import datetime as dt

from shoalkit.operators import keys
from shoalkit.plans import etl
from shoalkit.session import sealed


def test_dealt_index_numbers_like_global_index(spark):
    rows = [(None if i % 11 == 0 else dt.datetime(2020, 1, 1 + i % 28), None if i % 97 == 0 else f"k{i % 900}", i % 5, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string, w int, v int")
    got = keys.dealt_index(df, ["t", "k"], "i", start=3, ties=["w"])
    want = keys.global_index(df, ["t", "k"], "i", start=3, ties=["w"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.select("v", "i").collect())) == sorted(map(tuple, want.select("v", "i").collect()))
    assert len(keys._cuts(df, ["t", "k"])) > 20
    assert keys.dealt_index(df.limit(0), ["t", "k"], "i").count() == 0


def test_fish_rows_move_twice(spark):
    """To the key of their site and to their range of the index; points are taken on the way."""
    fish = [(f"f{i}", i % 40 if i % 9 else None, "10:00:00", float(i % 3), "SM", 5, 5, 5, "F", "not", "Y", "N", "RT", "n",
             None if i % 4 == 0 else -109.0 - i / 1000, None if i % 4 == 0 else 38.5) for i in range(400)]
    raw = spark.createDataFrame(fish, "key_aa string, key_a int, time string, rmi double, species string, tot_length int, st_length int, weight int, "
                                      "sex string, rep_cond string, tubercles string, ray_ct string, disp string, fish_notes string, ilon double, ilat double")
    samp = spark.createDataFrame([(k, f"s{k}", dt.datetime(2020, 1, 1 + k % 5), "DESO") for k in range(30)], "key_a int, site_id string, t_stamp timestamp_ntz, reach string")
    got = etl.build_fish(sealed(raw), sealed(samp))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [row_number") == 1 and "ExistingRDD" not in plan
    rows = {r.fish_id: r for r in got.collect()}
    assert sorted(r.f_index for r in rows.values()) == list(range(1, 401))
    means = {}
    for key, site, *_, lon, lat in fish:
        r = rows[key]
        assert r.site_id == (f"s{site}" if site is not None and site < 30 else None)
        if lon is not None:
            means.setdefault((r.site_id, r.rmi), []).append((lon, lat))
    for r in rows.values():  # fish without a site share the points of their mile, whatever their key
        here = means.get((r.site_id, r.rmi))
        assert (r.loc_x is None) == (r.epsg is None) == (here is None)
    lost = [r for r in rows.values() if r.site_id is None]
    assert len({r.key_a for r in lost}) > 2 and len({(r.rmi, r.loc_x, r.loc_y) for r in lost}) == 3
