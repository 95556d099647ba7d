"""Runs registered queries against their SQL on DuckDB; a helper of the tests, also a script."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def compare(spark, sf_dir: str, name: str, query, sql: str, allow_empty: bool = False) -> list[str]:
    """Problems found; empty when names, types, row count and all values agree exactly.

    An answer without rows proves nothing and counts as a problem unless it is allowed.
    """
    df = query(spark, sf_dir)
    con = duck(sf_dir)
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = answer.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for field in df.schema:
        kind = _KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != types[field.name]:
            problems.append(f"type of {field.name}: {kind} != {types[field.name]}")
    order = sorted(columns)
    actual = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=_sort_key)
    place = [columns.index(c) for c in order]
    wanted = sorted((tuple(_plain(r[i]) for i in place) for r in expected), key=_sort_key)
    if len(actual) != len(wanted):
        problems.append(f"rows {len(actual)} != {len(wanted)}")
    elif not actual and not allow_empty:
        problems.append("no rows")
    elif actual != wanted:
        bad = [(a, w) for a, w in zip(actual, wanted) if a != w]
        problems.append(f"{len(bad)} of {len(actual)} rows differ; {order}: {bad[:2]}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from caseloom.session import build_session

    sf_dir, wanted = argv[1], argv[2:]
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        started = time.time()
        try:
            problems = (compare(spark, sf_dir, name, queries[name], oracles[name])
                        if name in oracles else [f"no SQL; {queries[name](spark, sf_dir).count()} rows"])
        except Exception as exc:
            problems = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - started:.2f}s", *problems, flush=True)
    print(f"{failed} of {len(wanted or queries)} failed; no SQL for {sorted(set(queries) - set(oracles))}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
