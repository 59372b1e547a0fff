"""Differential check: every registered query against its DuckDB oracle
(sf0.001), compared as the driver does: columns by name, row count and an
order-insensitive hash of the values."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_registered():
    q = E.queries()
    assert len(q) >= 70
    assert set(ORACLES) <= set(q)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows is not None
        return
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", ["o01_critical_banners", "f04_window_text", "s06_read_batch_date",
                                  "s11_a27_partitioned_landing_avg_hr", "a01_gold_vitals"])
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    """The driver's session may use another zone: windows, batch dates and
    time texts are computed in UTC regardless."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(dcols, res.fetchall())[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "mews_score" in df.columns
