"""Running catalog entries beside their SQL."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def sql_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    fetched = result.fetchall()
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in fetched), key=repr)
