"""Compare registered queries with their SQL oracles: ``python tests/oracle_check.py [folder] [key …]``."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", float(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", None if v is None else str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, key, folder, plans, oracles):
    """``(ok, message)`` for one key."""
    df = plans[key](spark, folder)
    names = df.columns
    mine = rows_of(names, [tuple(r) for r in df.collect()])
    if key not in oracles:
        return True, f"rows only: {len(mine)}"
    cursor = con.execute(oracles[key])
    theirs_names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(theirs_names):
        return False, f"columns differ: {sorted(names)} / {sorted(theirs_names)}"
    types = {c[0]: str(c[1]) for c in cursor.description}
    theirs = rows_of(theirs_names, cursor.fetchall())
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows / {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return False, f"first difference:\n   mine   {a}\n   oracle {b}"
    mapped = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    odd = [f"{n}: {t} / {types[n]}" for n, t in df.dtypes if mapped.get(t) != types[n]]
    note = f"  [types {odd}]" if odd else ""
    return True, f"{len(mine)} rows{note}"


def main():
    import __spark_entry__ as entry
    from tagloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    plans, oracles = entry.queries(), entry.oracle_sql()
    keys = sys.argv[2:] or list(plans)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            ok, message = compare(spark, con, key, folder, plans, oracles)
        except Exception as error:  # report and go on with the next key
            ok, message = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {time.time() - start:6.2f}s {key}: {message}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} ok")


if __name__ == "__main__":
    main()
