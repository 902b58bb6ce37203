"""Compare a Spark DataFrame with a DuckDB query over the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from songpulse.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    # Through a view, as the driver runs it: SQL that cannot be a view must not pass here.
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_result AS {sql}")
    rel = con.sql("SELECT * FROM oracle_result")
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())


def compare(df, con, sql):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if sum(sr.values()) != sum(dr.values()):
        problems.append(f"row counts differ: spark={sum(sr.values())} duck={sum(dr.values())}")
    if not problems and sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems, sum(sr.values())
