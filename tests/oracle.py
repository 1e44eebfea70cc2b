"""Run registered queries next to their SQL twins and compare rows by value."""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def sortable(row):
    return tuple((v is None, type(v).__name__ if isinstance(v, str) else "", v if v is not None else 0) for v in row)


def rows_of(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(t[i]) for i in order) for t in tuples]
    return sorted(columns), sorted(rows, key=sortable)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if found[0] != expected[0]:
        return f"columns {found[0]} vs {expected[0]}"
    if len(found[1]) != len(expected[1]):
        return f"rows {len(found[1])} vs {len(expected[1])}"
    different = [(a, b) for a, b in zip(found[1], expected[1]) if a != b]
    if different:
        return f"{len(different)} of {len(found[1])} rows differ, first {different[0]} ({found[0]})"
    kinds = [(c, type(a), type(b)) for c, a, b in zip(found[0], *(r[1][0] for r in (found, expected)))] if found[1] else []
    odd = [k for k in kinds if k[1] is not k[2] and type(None) not in k[1:]]
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from airq.queries import ORACLES, QUERIES
    from airq.session import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = local_session(spark__ui__showConsoleProgress="false")
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, con, ORACLES[name]) if name in ORACLES else (None if df.collect() else "no rows")
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'sql ' if name in ORACLES else 'rows'} {problem or 'ok'}", flush=True)
    print(f"{bad} problems")
