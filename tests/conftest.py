import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SMALL}/{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    """Rows of a query equal those of its SQL, whatever their order."""

    def check(query, sql, sf_dir=SMALL):
        df = query(spark, sf_dir)
        got = sorted(tuple(map(plain, r)) for r in df.select(sorted(df.columns)).collect())
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        at = [names.index(c) for c in sorted(names)]
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())

    return check
