"""Run named queries beside their SQL and compare all rows.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", str(v)) for v in row)


def difference(con, df, sql: str) -> str | None:
    """None when both give the same rows and column types, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    right = sorted(([_plain(r[i]) for i in at] for r in theirs), key=_key)
    left = sorted(([_plain(r[c]) for c in cols] for r in df.collect()), key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    off = [(a, b) for a, b in zip(left, right) if a != b]
    if off:
        a, b = off[0]
        cells = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{len(off)} of {len(left)} rows differ, first {cells} in {a}"
    kinds = {d[0]: str(d[1]).upper() for d in con.execute(sql).description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [
        (c, t, kinds[c]) for c, t in df.dtypes if t in same and kinds[c] != same[t] and kinds[c] != "NUMBER"
    ]
    return f"types {odd}" if odd else None


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from lendspark.session import build_session

    spark = build_session(
        "compare", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                what = difference(con, df, sql[name])
                n = con.execute(f"SELECT count(*) FROM ({sql[name]})").fetchall()[0][0]
            else:
                n, what = len(df.collect()), None
        except Exception as err:  # a broken query must not hide the others
            what, n = f"{type(err).__name__}: {str(err)[:600]}", "?"
        bad += what is not None
        kind = "sql" if name in sql else "rows"
        print(f"{'ok ' if what is None else 'BAD'} {kind:4} {name:32} {n!s:>8} rows {time.time() - start:6.2f}s {what or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
