"""Compare registered queries with DuckDB: ``python tests/oracle.py sf_dir [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, int):
        return value
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value.asDict().values())
    if isinstance(value, dict):
        return tuple(_plain(v) for v in value.values())
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(query, sql, spark, con, folder) -> str | None:
    """None if the results are equal, else what differs."""
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    short = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {n: (t, kinds[n]) for n, t in df.dtypes if short.get(t) != kinds[n]}
    if odd:
        return f"types differ: {odd}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return None if a else "no rows"
    extra, missing = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
    return f"rows {len(a)} / {len(b)}; columns {sorted(names)}; only here {extra}; only there {missing}"


def main(folder: str, *names: str) -> int:
    from millrace import build_session
    from millrace.catalog import all_queries, all_sql

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), all_sql(), 0
    for name, query in all_queries().items():
        if names and not any(name == n or name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            problem = difference(query, sql.get(name), spark, con, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name}{'' if name in sql else ' (rows only)'}"
              f"{'' if problem is None else ' -> ' + problem}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
