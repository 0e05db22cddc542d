"""Compare registered Spark plans with their DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from kestrel.sources.tables import TABLES


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted([cols[i] for i in order]), sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if d_types.get(f.name) != want:
            return False, f"type of {f.name}: spark={f.dataType.simpleString()} duck={d_types.get(f.name)}"
    sc, sr = rows_sorted(s_cols, s_rows)
    dc, dr = rows_sorted(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ (first: {diff})"
    return True, f"{len(sr)} rows"
