"""Run a registered query and its SQL check side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, folder, fn, sql) -> str | None:
    """None when both agree, else what differs."""
    df = fn(spark, folder)
    mine_cols, mine = _table(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    theirs_cols, theirs = _table([d[0] for d in result.description], result.fetchall())
    if mine_cols != theirs_cols:
        return f"columns {mine_cols} != {theirs_cols}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}; {mine[:2]} / {theirs[:2]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {wrong[0]}" if wrong else None
