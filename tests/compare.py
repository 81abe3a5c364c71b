"""Run a named query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    return value


def canonical(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(got: tuple, want: tuple, tol: float = 2e-6) -> list[str]:
    """Column names, row counts and values; the last digit of a rounded float may differ."""
    (gn, gr), (wn, wr) = canonical(*got), canonical(*want)
    if gn != wn:
        return [f"columns {gn} != {wn}"]
    if len(gr) != len(wr):
        return [f"{len(gr)} rows != {len(wr)}"]
    bad = []
    for g, w in zip(gr, wr):
        same = all(
            (abs(a - b) <= tol if isinstance(a, float) and isinstance(b, (int, float)) else a == b) for a, b in zip(g, w)
        )
        if not same:
            bad.append(f"{g} != {w}")
    return bad
