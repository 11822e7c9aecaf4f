"""Run registered queries beside their SQL and report every difference.

``python -m checks.compare [sf] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES

TESTDATA = "/root/testdata"
SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str:
    frame = QUERIES[name](spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    got = rows_of(frame.columns, frame.collect())
    if name not in ORACLE:
        return f"rows only ({sum(got.values())})"
    result = connection.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"DIFFERENT columns {sorted(frame.columns)} / {sorted(names)}"
    odd = {d[0]: (types[d[0]], str(d[1])) for d in result.description if SAME_TYPE.get(types[d[0]]) != str(d[1])}
    want = rows_of(names, result.fetchall())
    if got == want and odd:
        return f"DIFFERENT types {odd}"
    if got == want:
        return f"same ({sum(got.values())})"
    extra, lost = got - want, want - got
    return (
        f"DIFFERENT rows {sum(got.values())} / {sum(want.values())}; "
        f"only here {list(extra)[:2]}; only in SQL {list(lost)[:2]}"
    )


def main() -> int:
    from driverlens.session import build_session

    sf_dir = f"{TESTDATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        begin = time.time()
        try:
            verdict = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on: this is a survey of all queries
            verdict = f"FAILED {type(error).__name__}: {str(error)[:400]}"
        bad += verdict.startswith(("DIFFERENT", "FAILED"))
        print(f"{name}: {verdict} [{time.time() - begin:.1f}s]", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
