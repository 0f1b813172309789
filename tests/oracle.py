"""Rows of a query and of its SQL, compared without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path("/root/testdata")


def sql_rows(sql: str, sf: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        p = DATA / sf / f"{t}.parquet"
        con.execute(f"create view {t} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    if type(a) is not type(b):
        return False
    return a == b


def check(df, sql: str, sf: str) -> None:
    (n1, r1), (n2, r2) = spark_rows(df), sql_rows(sql, sf)
    assert n1 == n2
    assert len(r1) == len(r2)
    bad = [(x, y) for x, y in zip(r1, r2, strict=True) if not all(same(p, q) for p, q in zip(x, y, strict=True))]
    assert not bad, bad[:5]
