"""Run a query and its SQL check on the same data and compare names, types and values."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str | Path):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def assert_same(df, con, sql: str) -> int:
    """Fails unless the two results are the same multiset; returns the number of rows."""
    names = sorted(df.columns)
    result = con.execute(f"select {', '.join(f'\"{n}\"' for n in names)} from ({sql})")
    sql_types = {c[0]: str(c[1]) for c in result.description}
    assert sql_types == {n: TYPES[t] for n, t in df.dtypes}
    expected = Counter(result.fetchall())
    actual = Counter(map(tuple, df.select(*names).collect()))
    assert sum(actual.values()) == sum(expected.values())
    assert actual == expected
    return sum(actual.values())
