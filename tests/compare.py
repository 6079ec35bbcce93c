"""Run named queries and their SQL on the same files and compare rows as bags.

``python -m tests.compare [folder] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, folder, name, fn, sql):
    """None when equal, else a short account of the difference."""
    df = fn(spark, folder)
    mine = bag(df.collect(), df.columns)
    con = connect(folder)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = bag(cursor.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} / {sorted(columns)}"
    if mine == theirs:
        return None
    only, missing = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
    clip = lambda x: str(x)[:700]
    return (
        f"{name}: rows {sum(mine.values())} / {sum(theirs.values())}\n  mine {clip(only)}\n  sql  {clip(missing)}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from citylake import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]
    spark = session.build("local[8]", "compare", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                result = difference(spark, folder, name, fn, oracles[name])
            else:
                result = f"{name}: no SQL, {fn(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            result = f"{name}: {type(error).__name__} {str(error)[:900]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.1f}s", flush=True)
        if result:
            print("   ", result, flush=True)
    print("differences:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
