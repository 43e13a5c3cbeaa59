"""Compare every registered query with its SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _key(value):
    if isinstance(value, decimal.Decimal):
        return str(float(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    frame = query(spark, sf_dir)
    types = dict(frame.dtypes)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected = {row[0]: row[1] for row in described}
    problems = []
    if set(types) != set(expected):
        problems.append(f"columns differ: {sorted(set(types) ^ set(expected))}")
        return problems
    for name, kind in types.items():
        if _SAME_TYPE.get(kind) != expected[name]:
            problems.append(f"type of {name}: {kind} vs {expected[name]}")
    got = canonical(list(types), frame.collect())
    want = canonical(list(expected), con.execute(sql).fetchall())
    if len(got) != len(want):
        problems.append(f"rows: {len(got)} vs {len(want)}")
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        names = sorted(types)
        a, b = wrong[0]
        first = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(wrong)} of {len(want)} rows differ, first: {first}")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tripstrata.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        if name not in sqls:
            print(f"---- {name}: {len(query(spark, sf_dir).collect())} rows, no SQL")
            continue
        try:
            problems = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ")
    print(f"{bad} of {len(sqls)} differ; no SQL: {sorted(set(queries()) - set(sqls))}; no query: {sorted(set(sqls) - set(queries()))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
