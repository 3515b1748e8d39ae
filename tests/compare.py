"""Run a query in Spark and its SQL in DuckDB and compare the rows, whatever their order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    return value


def _kind(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "double": "double", "bigint": "bigint", "integer": "int", "hugeint": "hugeint"}.get(name, name)


def differences(df, connection, sql: str) -> list[str]:
    """What differs between the Spark frame and the SQL result; empty when equal."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: _kind(str(d[1])) for d in relation.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema:
        if field.dataType.simpleString() != kinds[field.name] and not kinds[field.name].endswith("[]"):
            problems.append(f"{field.name} is {field.dataType.simpleString()} against {kinds[field.name]}")
    order = sorted(names)
    ours = Counter(tuple(_cell(r[n]) for n in order) for r in df.collect())
    at = [names.index(n) for n in order]
    theirs = Counter(tuple(_cell(r[i]) for i in at) for r in relation.fetchall())
    if ours != theirs:
        problems.append(f"{ours.total()} rows against {theirs.total()}")
        problems += [f"only here: {dict(zip(order, r))}" for r in list((ours - theirs))[:2]]
        problems += [f"only there: {dict(zip(order, r))}" for r in list((theirs - ours))[:2]]
    return problems
