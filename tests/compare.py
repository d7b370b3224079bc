"""Runs a registered query and its SQL twin on the same tables and compares the rows."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    con.execute("set threads to 8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_types(df):
    return sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)


def compare(df, con, sql):
    """An empty string when both sides agree, else what differs first."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = sorted((d[0], str(d[1])) for d in rel.description)
    theirs = bag(names, rel.fetchall())
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        return (
            f"rows {sum(ours.values())} / {sum(theirs.values())}; only ours {list((ours - theirs).items())[:2]};"
            f" only theirs {list((theirs - ours).items())[:2]}"
        )
    known = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wrong = [(a, b) for a, b in zip(spark_types(df), types) if known.get(a[1], a[1]) != b[1]]
    return f"types {wrong}" if wrong else ""
