"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return sorted(columns), sorted(tuple(value(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir, make, sql, shown=3):
    """None if equal, else a short account."""
    df = make(spark, sf_dir)
    got_columns, got = canonical(df.columns, df.collect())
    relation = con.sql(sql)
    want_columns, want = canonical(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, absent = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; only here {sorted(extra)[:shown]}; only SQL {sorted(absent)[:shown]}"
    return None
