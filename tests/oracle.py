"""Compare a query with its SQL on DuckDB."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder, f"{name}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """(rows, differences, types) of both sides."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = _rows(names, found.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    types = sorted((d[0], str(d[1])) for d in con.execute(sql).description), sorted(df.dtypes)
    return len(want), [(g, w) for g, w in zip(got, want) if g != w] + ([(len(got), len(want))] if len(got) != len(want) else []), types
