"""Compare a query with its SQL on DuckDB: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

from listingflow.queries.base import TABLES

KINDS = {
    "HUGEINT": "bigint", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "SMALLINT": "smallint",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (bool, int, str, dt.date, dt.datetime)) or v is None:
        return v
    return str(v)


def compare(spark, con, folder: str, name: str, run, sql: str) -> list[str]:
    """Differences in words; none means agreement."""
    df = run(spark, folder)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in rel.description}
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for c, t in df.dtypes:
        if t != kinds[c]:
            problems.append(f"type of {c}: {t} vs {kinds[c]}")
    order = sorted(names)
    want = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in rel.fetchall())
    got = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    if sum(got.values()) != sum(want.values()):
        problems.append(f"rows {sum(got.values())} vs {sum(want.values())}")
    if sum(want.values()) == 0:
        problems.append("no rows")
    extra, lacking = got - want, want - got
    if extra or lacking:
        problems.append(f"columns {order}; only spark: {list(extra)[:3]}; only sql: {list(lacking)[:3]}")
    return problems
