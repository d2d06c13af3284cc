"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, otherwise what does not."""
    described = [(r[0], r[1]) for r in con.execute(f"describe {sql}").fetchall()]
    expected_types = dict(described)
    found_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if found_types != expected_types:
        return f"types: spark {found_types} sql {expected_types}"
    expected = _rows([c for c, _ in described], con.execute(sql).fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"rows: spark {len(found)} sql {len(expected)}"
    wrong = [(f, e) for f, e in zip(found, expected) if f != e]
    return f"{len(wrong)} of {len(found)} rows differ, first: {wrong[0]}" if wrong else None
