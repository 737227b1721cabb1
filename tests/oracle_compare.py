"""Run a Spark result and its DuckDB oracle side by side (row count, columns, values)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(records, cols) -> list[tuple]:
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_mismatches(spark_df, rel) -> dict:
    st = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (t, dt.get(c)) for c, t in st.items() if SPARK_TO_DUCK.get(t, t) != dt.get(c)}


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    got = [r.asDict() for r in spark_df.collect()]
    scols = sorted(spark_df.columns)
    con = duck(sf_dir)
    bad_types = type_mismatches(spark_df, con.sql(sql))
    res = con.execute(sql)
    dcols_raw = [d[0] for d in res.description]
    drows = [dict(zip(dcols_raw, r)) for r in res.fetchall()]
    dcols = sorted(dcols_raw)
    out = {"spark_rows": len(got), "oracle_rows": len(drows), "cols_equal": scols == dcols, "types_equal": not bad_types}
    if bad_types:
        out["type_mismatches"] = bad_types
    if scols != dcols:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
        return out
    a, b = rows_of(got, scols), rows_of(drows, dcols)
    out["values_equal"] = a == b
    if a != b:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb, key=str)[:3]
        out["only_oracle"] = sorted(sb - sa, key=str)[:3]
    return out
