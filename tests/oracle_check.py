"""Compare queries with their SQL twins in DuckDB: `python tests/oracle_check.py FOLDER [name ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def rows_of(frame):
    columns = sorted(frame.columns)
    return columns, sorted(
        "|".join("NULL" if _missing(v) else repr(_plain(v)) for v in row)
        for row in frame[columns].itertuples(index=False, name=None)
    )


def _missing(v) -> bool:
    return v is None or v != v


def _plain(v):
    v = v.item() if hasattr(v, "item") else v
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v


def compare(spark, con, name, fn, sql, folder):
    """(same, Spark rows, DuckDB rows, seconds, detail)."""
    start = time.time()
    got = fn(spark, folder).toPandas()
    seconds = time.time() - start
    want = con.execute(sql).df()
    columns, left = rows_of(got)
    names, right = rows_of(want)
    detail = ""
    if columns != names:
        detail = f"columns {columns} != {names}"
    elif left != right:
        only = [x for x in left if x not in set(right)][:2], [x for x in right if x not in set(left)][:2]
        detail = f"rows differ: {only}"
    return not detail, len(left), len(right), seconds, detail


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def main(folder, names):
    import __spark_entry__ as entry
    from pointflow import get_session

    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        try:
            if name in oracles:
                same, n, m, seconds, detail = compare(spark, con, name, fn, oracles[name], folder)
            else:
                start = time.time()
                n = m = fn(spark, folder).count()
                same, seconds, detail = n > 0, time.time() - start, "rows only"
        except Exception as error:  # report and go on
            same, n, m, seconds, detail = False, 0, 0, 0.0, repr(error)[:600]
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} {n:8d} {m:8d} {seconds:6.2f}s {detail}", flush=True)
        if not same:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
