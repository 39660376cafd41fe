"""Every registered query of the library against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

from sluice.plans import registered

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registered()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return float(v) if type(v).__name__ == "Decimal" else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == columns
    rows = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({SQL[name]})").fetchall()
    assert ordered(df.select(*[f"`{c}`" for c in columns]).collect()) == ordered(rows)
