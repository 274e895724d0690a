"""Runs registered queries and their check SQL on the driver tables and compares whole results."""

import collections
import math

import duckdb
from pyspark.sql import DataFrame

from chondria.registry.inputs import TABLES

KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.12g}")
    return v


def _bag(rows, order):
    return collections.Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con, sql: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if k != kinds[c]}
    if wrong:
        out.append(f"types {wrong}")
    ours = _bag(df.collect(), [df.columns.index(c) for c in sorted(names)])
    theirs = _bag(result.fetchall(), [names.index(c) for c in sorted(names)])
    if sum(ours.values()) != sum(theirs.values()):
        out.append(f"rows {sum(ours.values())} / {sum(theirs.values())}")
    if ours != theirs:
        out.append(f"{sorted(names)} only spark {list((ours - theirs).items())[:2]} only sql {list((theirs - ours).items())[:2]}")
    return out
