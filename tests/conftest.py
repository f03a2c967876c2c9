import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from shoalkit.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]").appName("shoalkit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="shoalkit-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()

    def run(sf_dir, sql):
        c = duckdb.connect()
        for t in ("region nation customer supplier part orders lineitem events documents embeddings "
                  "pages benchmark labels conversations").split():
            p = f"{sf_dir}/{t}.parquet"
            if os.path.exists(p):
                c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return c.execute(sql).df()
    yield run
    con.close()
