"""Cross-engine comparison used by the tests and by ``python -m tests.oracle_compare``:
runs each named Spark query and its DuckDB oracle on the same Parquet tables and compares
column names and the multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

import duckdb

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return ([names[i] for i in order],
            Counter(tuple(norm(r[i]) for i in order) for r in rows))


# Spark type -> DuckDB type of the same values.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def type_mismatches(df, con, sql):
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, t, duck_types.get(c)) for c, t in df.dtypes if TYPES.get(t, t) != duck_types.get(c)]


def compare(spark, sf_dir: str, name: str, con=None, verbose=False):
    import __spark_entry__ as E
    df = E.queries()[name](spark, sf_dir)
    s_names, s_rows = rows_of(df.columns, df.collect())
    con = con or duck(sf_dir)
    types = type_mismatches(df, con, E.oracle_sql()[name])
    res = con.execute(E.oracle_sql()[name])
    d_names = [d[0] for d in res.description]
    d_names, d_rows = rows_of(d_names, res.fetchall())
    ok = s_names == d_names and s_rows == d_rows and not types
    info = {"name": name, "ok": ok, "spark_rows": sum(s_rows.values()),
            "oracle_rows": sum(d_rows.values()), "spark_cols": s_names, "oracle_cols": d_names,
            "type_mismatches": types}
    if not ok and verbose:
        only_s = list((s_rows - d_rows).elements())[:5]
        only_d = list((d_rows - s_rows).elements())[:5]
        info["only_spark"], info["only_oracle"] = only_s, only_d
    return info


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from shelfspark.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(E.oracle_sql())
    spark = build_session("local[8]")
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            info = compare(spark, sf, n, con, verbose=True)
        except Exception as exc:  # report and continue
            info = {"name": n, "ok": False, "error": repr(exc)[:2000]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
