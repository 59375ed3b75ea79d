import os

import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def same():
    """Compares a query's rows with those of its SQL, floats to nine digits."""
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")

    def plain(x):
        return float(f"{x:.9g}") if isinstance(x, float) else x

    def check(df, sql):
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(df.columns) == sorted(names)
        want = sorted((repr([plain(dict(zip(names, row))[c]) for c in sorted(names)]) for row in found.fetchall()))
        got = sorted(repr([plain(row[c]) for c in sorted(names)]) for row in df.collect())
        assert len(got) == len(want)
        assert got == want

    return check
