"""Compare registered queries with their SQL counterparts in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) or (a != a and b != b)
    return a == b


def compare(spark_df, con, sql: str) -> list[str]:
    """Problems found; an empty list means that the two sides agree."""
    cur = con.execute(sql)
    sql_cols = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description}
    spark_cols = dict(spark_df.dtypes)
    if sql_cols != spark_cols:
        return [f"schema: spark {spark_cols} sql {sql_cols}"]
    names = sorted(sql_cols)
    at = [list(sql_cols).index(n) for n in names]
    expected = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=_key)
    got = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=_key)
    problems = []
    if len(expected) != len(got):
        problems.append(f"rows: spark {len(got)} sql {len(expected)}")
    for g, e in zip(got, expected):
        if not all(map(_same, g, e)):
            problems.append(f"first difference:\n  columns {names}\n  spark {g}\n  sql   {e}")
            break
    return problems
