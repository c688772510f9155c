"""Every query with SQL gives what DuckDB gives; the others give rows."""

import datetime
import decimal
import math

import duckdb
import pytest

from meterline.plans import catalogue, customers, meters, models, sinks  # noqa: F401

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float | decimal.Decimal):
        return f"{float(v):.6g}"
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n in catalogue.SQL])
def test_same_as_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, D)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(catalogue.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.SQL])
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, D).count() > 0
