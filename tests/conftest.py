import decimal
import math
import os

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


DATA = "/root/testdata/sf0.001"


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(round(float(value), 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(_plain, value)) + "]"
    return str(value)


@pytest.fixture(scope="session")
def twin(spark):
    """Compares a query with its SQL over the smallest data, rows as a bag."""
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")

    def compare(query, sql):
        df = query(spark, DATA)
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(df.columns) == sorted(names)
        theirs = sorted(tuple(_plain(r[names.index(c)]) for c in sorted(names)) for r in result.fetchall())
        ours = sorted(tuple(_plain(r[c]) for c in sorted(names)) for r in df.collect())
        assert ours == theirs

    return compare
