"""Compare registered queries with their SQL: names, row count, sorted values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError(f"decimal in a result: {value}")
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.date):
        raise TypeError("date or time in a result")
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return names, sorted(cells, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, folder: str, name: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    got = _normal(df.columns, [tuple(r) for r in df.collect()])
    con.execute(sql)
    want = _normal([d[0] for d in con.description], con.fetchall())
    if got[0] != want[0]:
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    diff = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    if diff:
        g, w = diff[0]
        cells = [(n, a, b) for n, a, b in zip(got[0], g, w, strict=True) if a != b]
        return f"{len(diff)} rows differ, first: {cells[:4]} in {g[:6]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from shelfwatch.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, query, sqls[name]) if name in sqls else "no sql"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
