"""Comparison of a query with its SQL on the same tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def norm(v):
    v = v.item() if hasattr(v, "item") else v
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, int | float | Decimal) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, sql, sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as from '{p}'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs
