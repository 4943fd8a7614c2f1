"""Compare queries with their SQL. ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from wordmill.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(keyed, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, sf_dir: str, name: str):
    """(spark rows, sql rows or None, seconds, difference or None)."""
    start = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    seconds = time.time() - start
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return len(got), None, seconds, None
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    difference = None
    if sorted(columns) != sorted(df.columns):
        difference = f"columns {sorted(df.columns)} / {sorted(columns)}"
    elif got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        difference = f"{len(got)} / {len(want)} rows, {len(pairs)} differ, first {str(pairs[:1])[:600]}"
    return len(got), len(want), seconds, difference


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in names:
        try:
            n, m, seconds, difference = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            difference, n, m, seconds = f"{type(error).__name__}: {str(error)[:700]}", -1, -1, 0
        print(f"{'BAD' if difference else 'ok ' if m is not None else 'rows'} {name} {n} {m} {seconds:.1f}s", flush=True)
        if difference:
            bad.append(name)
            print("   ", difference, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
