"""Run a registered query and its SQL twin over the same tables and compare them value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, run, sql, sf_dir) -> list[str]:
    """Empty when both engines agree on columns, types and rows."""
    df = run(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [str(d[1]) for d in cur.description]
    other = cur.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    theirs = dict(zip(names, kinds, strict=True))
    for name, kind in df.dtypes:
        if same.get(kind, kind) != theirs[name]:
            found.append(f"type of {name}: {kind} against {theirs[name]}")
    if len(mine) != len(other):
        found.append(f"rows {len(mine)} against {len(other)}")
    a, b = _rows(df.columns, mine), _rows(names, other)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        found.append(f"{len(only_a)} rows only here {only_a[:3]}, {len(only_b)} only there {only_b[:3]}")
    return found
