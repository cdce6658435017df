"""Run a registered query and its SQL on the same tables and compare them."""

from __future__ import annotations

import glob
import os

import duckdb

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty when they agree."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} against {sorted(relation.columns)}"]
    spark_kinds = {n: KINDS.get(k, k) for n, k in df.dtypes}
    sql_kinds = dict(zip(relation.columns, map(str, relation.types)))
    found = [f"{n}: {spark_kinds[n]} against {sql_kinds[n]}" for n in names if spark_kinds[n] != sql_kinds[n]]
    mine = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(relation.project(quoted).fetchall(), key=_key)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, such as {wrong[0]}")
    return found
