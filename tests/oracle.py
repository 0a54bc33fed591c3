"""Runs a query and its SQL twin and compares them as unordered sets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql):
    """An empty string if equal, else what differs."""
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    sql_types = {row[0]: str(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if spark_types != sql_types:
        return f"types {sorted(spark_types.items())} != {sorted(sql_types.items())}"
    cur = con.execute(sql)
    want_names, want = _bag([d[0] for d in cur.description], cur.fetchall())
    got_names, got = _bag(df.columns, [tuple(x) for x in df.collect()])
    if want_names != got_names:
        return f"columns {got_names} != {want_names}"
    if want != got:
        extra, lacking = got - want, want - got
        return (f"{sum(got.values())} rows against {sum(want.values())}; {sum(extra.values())} differ: "
                f"spark {list(extra)[:3]} sql {list(lacking)[:3]}")
    return ""
