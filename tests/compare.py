"""Compare a Spark result with its SQL twin run by DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    if isinstance(value, (bool, int)):
        return int(value)
    return value if isinstance(value, str) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), sorted(columns)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when both results hold the same rows."""
    got, got_columns = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    want, want_columns = _rows(names, relation.fetchall())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    problems = [] if len(got) == len(want) else [f"{len(got)} rows, {len(want)} expected"]
    if got != want:
        have, need = set(got), set(want)
        missing = [r for r in want if r not in have][:limit]
        extra = [r for r in got if r not in need][:limit]
        if missing or extra or problems:
            problems += [f"missing {r}" for r in missing] + [f"extra {r}" for r in extra]
    return problems
