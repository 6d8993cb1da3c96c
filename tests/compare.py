"""Compare a Spark result with the result of its SQL in DuckDB, as sorted rows."""

from __future__ import annotations

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    return names, kinds, result.fetchall()


def _key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


SAME_KIND = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
             "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def differences(df, sf_dir: str, sql: str) -> list[str]:
    """What differs between the two results; empty when nothing does."""
    names, kinds, expected = oracle_rows(sf_dir, sql)
    got_names, got = spark_rows(df)
    problems = []
    e_names, e_rows = ordered(names, expected)
    g_names, g_rows = ordered(got_names, got)
    if e_names != g_names:
        return [f"columns {g_names} instead of {e_names}"]
    for name, kind in df.dtypes:
        if SAME_KIND.get(kinds[name], kinds[name]) != kind:
            problems.append(f"{name} is {kind}, SQL gives {kinds[name]}")
    if len(e_rows) != len(g_rows):
        problems.append(f"{len(g_rows)} rows instead of {len(e_rows)}")
    unlike = [(g, e) for g, e in zip(g_rows, e_rows) if g != e]
    if unlike:
        problems.append(f"{len(unlike)} rows differ, first {unlike[0][0]} instead of {unlike[0][1]}")
    return problems
