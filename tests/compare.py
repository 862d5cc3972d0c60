"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, 5) + 0.0
    if isinstance(v, int):
        return float(v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 5) + 0.0
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql) -> str | None:
    got_c, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_c, want = rows_of(names, cur.fetchall())
    if got_c != want_c:
        return f"columns {got_c} != {want_c}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    real = [(a, b) for a, b in bad if not _close(a, b)]
    if real:
        return f"{len(real)} rows differ, first {real[0]}"
    return None


def _close(a, b):
    for x, y in zip(a, b):
        if x == y:
            continue
        if isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-6 * max(1, abs(x)):
            continue
        return False
    return True
