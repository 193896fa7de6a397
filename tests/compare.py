"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def _key(row):
    return tuple((v is None, str(type(v)) if not isinstance(v, (int, float)) else "", v if v is not None else 0) for v in row)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=lambda r: str(r))


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences, as text; empty when the results agree exactly."""
    names, mine = as_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    other_names, other = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return [f"columns differ: only here {sorted(set(names) - set(other_names))}, "
                f"only there {sorted(set(other_names) - set(names))}"]
    if len(mine) != len(other):
        return [f"rows differ: {len(mine)} and {len(other)}"]
    diffs = []
    for a, b in zip(mine, other):
        for n, x, y in zip(names, a, b):
            if x != y or type(x) is not type(y):
                diffs.append(f"{n}: {x!r} and {y!r} in {a[:3]} / {b[:3]}")
    return diffs
