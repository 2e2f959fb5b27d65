"""Compare a query with its DuckDB equivalent: names, types and all rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

DUCKDB_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def difference(df, connection, sql: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    names = sorted(df.columns)
    result = connection.execute(sql)
    oracle_names = [d[0] for d in result.description]
    oracle_types = [str(d[1]) for d in result.description]
    if sorted(oracle_names) != names:
        return f"columns {names} / {sorted(oracle_names)}"
    types = {n: t for n, t in df.dtypes}
    for name, kind in zip(oracle_names, oracle_types):
        if types[name] != DUCKDB_TYPES.get(kind, kind):
            return f"type of {name}: {types[name]} / {kind}"
    order = [oracle_names.index(n) for n in names]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    ours = Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())
    if ours != theirs:
        return (
            f"rows {ours.total()} / {theirs.total()}; only ours {list((ours - theirs).items())[:3]}; "
            f"only theirs {list((theirs - ours).items())[:3]}"
        )
    return None
