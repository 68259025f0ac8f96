"""Runs a query and its SQL and compares rows, columns sorted by name."""

import glob
import os

import duckdb

from corvid.session import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if os.path.isfile(p) else p + '/*'}')")
    return con


def cell(x):
    if x is None:
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, int):
        return str(x)
    try:
        return f"{float(x):.6f}" if not isinstance(x, str) else x
    except (TypeError, ValueError):
        return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(tuple(cell(r[k]) for k in order) for r in data)


def compare(con, df, sql):
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = rows([c[0] for c in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
        return f"{len(mine[1])} / {len(theirs[1])} rows; only mine {str(sorted(a)[:2])[:500]}; only SQL {str(sorted(b)[:2])[:500]}"
    return None
