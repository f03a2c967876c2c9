"""The key index asks one narrow row a key, however many files a store has."""

from shoalkit.session import scratch_path
from shoalkit.sources import store


def test_keys_asked_for_travel_once_however_many_files(spark, monkeypatch):
    root = scratch_path(spark, "t-words")
    for k in range(6):  # every file covers every key's range
        store.append(spark, {"fish": spark.range(1000).selectExpr(f"concat('f', id * 6 + {k}) AS fish_id", "'s' AS site_id").repartition(4)}, root)
    seen, real = [], store._asked_words
    monkeypatch.setattr(store, "_asked_words", lambda *a: seen.append(real(*a)) or seen[-1])
    asked = spark.range(5000).selectExpr("concat('f', id) AS site_id")
    found = store.with_keys(spark, root, "fish", asked)
    assert found.join(asked.withColumnRenamed("site_id", "fish_id"), "fish_id", "left_semi").count() == 5000
    assert [d.count() for d in seen] == [5000] * len(seen) and seen
