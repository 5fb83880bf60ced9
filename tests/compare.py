"""Rows of a Spark result and of DuckDB SQL over the same tables, in a form that can be compared."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    return round(v, 12) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v


def spark_rows(df) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    db = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    out = db.sql(sql)
    order = sorted(range(len(out.columns)), key=lambda i: out.columns[i])
    return [out.columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in out.fetchall()), key=repr)
