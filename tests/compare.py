"""Run a query in Spark and its SQL twin in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows(columns: list[str], table) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(plain(r[n]) for n in order) for r in table), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} and {sorted(names)}"]
    ours, theirs = rows(spark_df.columns, spark_df.collect()), rows(names, found.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows and {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b:
            problems.append(f"{str(a)[:400]}\n      {str(b)[:400]}")
            break
    return problems
