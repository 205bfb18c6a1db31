"""Run a query and its SQL side by side and compare all rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, dict)):
        return repr(value)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if expected != found:
        out.append(f"rows {sum(found.values())} vs {sum(expected.values())}")
        out.append(f"only spark {list((found - expected).items())[:3]}")
        out.append(f"only sql   {list((expected - found).items())[:3]}")
    elif not found:
        out.append("no rows on either side")
    short = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for f in df.schema.fields:
        want = short.get(f.dataType.simpleString())
        if want and f.name in types and types[f.name].upper() not in (want, want.lower()):
            out.append(f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}")
    return out
