"""Every registered query with SQL gives the SQL's rows (smallest tables)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "customer orders events documents pages benchmark labels".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


NAMES = sorted(n for n in entry.oracle_sql() if n.split("_")[0] in ("P1", "P2", "P3", "P4", "P5", "P10", "M3", "M8", "M12", "G1", "G6", "D3", "N2", "H1", "H7", "C1", "R5"))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df, ref = entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(ref.columns)
    assert rows(df.columns, df.collect()) == rows(ref.columns, ref.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_only_known_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
