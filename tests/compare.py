"""Order-insensitive comparison of a Spark result with DuckDB's."""

import math
import os


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return repr(round(float(v), 6))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def from_duck(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def from_spark(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
