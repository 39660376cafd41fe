"""Queries against their SQL where keys are as large as those of large tables."""

import duckdb
import pytest

from sluice.plans import registered
from test_queries import ordered

QUERIES, SQL = registered()
DATA = "/root/testdata/sf0.001"
TABLES = {"customer": "c_custkey", "orders": "o_custkey", "part": "p_partkey", "lineitem": "l_suppkey"}


@pytest.mark.parametrize("name", ["directory_keys", "radar_unmatched", "resolver_keys"])
def test_ids_of_large_keys(name, spark, tmp_path):
    con = duckdb.connect()
    for table, key in TABLES.items():
        con.sql(f"COPY (SELECT * REPLACE ({key} + 89950 AS {key}) FROM '{DATA}/{table}.parquet') TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    assert ordered(df.collect()) == ordered(con.sql(f"SELECT {columns} FROM ({SQL[name]})").fetchall())
