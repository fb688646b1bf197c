"""Spark results against DuckDB's on the same Parquet tables."""

import math
import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck(sf=SF):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 7) + 0.0
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def same(df, con, sql):
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = table(columns, cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
