"""Compare registered queries with their SQL counterparts, row by row.

Usage: python -m workload.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Type names of both engines that mean the same.
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(frame, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: SAME_TYPE.get(kind, kind) for name, kind in frame.dtypes}
    if ours != theirs:
        return f"columns {sorted(set(ours.items()) ^ set(theirs.items()))}"
    mine = _bag(frame.columns, frame.collect())
    other = _bag(list(theirs), result.fetchall())
    if mine == other:
        return None
    return (
        f"rows {sum(mine.values())} and {sum(other.values())}; "
        f"only here {list((mine - other).items())[:3]}; only there {list((other - mine).items())[:3]}"
    )


def main() -> int:
    from headway.session import build_session
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            problem = differences(QUERIES[name](spark, folder), con, ORACLE[name])
        except Exception as error:  # noqa: BLE001
            problem = f"error {str(error)[:600]}"
        failed += problem is not None
        print(f"{name}: {problem or 'same'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} the same")
    return failed


if __name__ == "__main__":
    sys.exit(main())
