"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    found = con.execute(sql)
    sql_columns = [d[0] for d in found.description]
    sql_rows = found.fetchall()
    problems = []
    if sorted(df.columns) != sorted(sql_columns):
        return [f"columns {sorted(df.columns)} against {sorted(sql_columns)}"]
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(sql_columns, sql_rows)
    if ours != theirs:
        problems.append(f"rows {sum(ours.values())} against {sum(theirs.values())}")
        problems += [f"  ours   {x}"[:600] for x in list((ours - theirs))[:2]]
        problems += [f"  theirs {x}"[:600] for x in list((theirs - ours))[:2]]
    return problems


if __name__ == "__main__":
    from broadsheet import plans
    from broadsheet.session import build_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = plans.oracle_sql()
    bad = 0
    for name, fn in plans.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                problems = differences(df, con, oracles[name])
                count = None
            else:
                count, problems = len(df.collect()), []
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        status = "ok  " if not problems else "FAIL"
        bad += bool(problems)
        print(status, name, f"{time.time() - t:.2f}s", "" if name in oracles else "(rows only)", flush=True)
        for p in problems:
            print("    ", p, flush=True)
    print("failures", bad)
