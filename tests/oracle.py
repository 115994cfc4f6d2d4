"""Runs a registered query and its SQL check on the same tables and compares schema and rows."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if type(value).__name__ == "Decimal":
        return repr(round(float(value), 6) + 0.0)
    return str(value)


def kind(value) -> str:
    name = type(value).__name__
    return {"bool": "bool", "int": "int", "float": "float", "str": "str"}.get(name, name)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple], dict]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {names[i]: {kind(r[i]) for r in rows if r[i] is not None} for i in order}
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows), kinds


def compare(df, sql: str, connection) -> str | None:
    """NULL if equal, else what differs."""
    names, rows, kinds = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    sql_names, sql_rows, sql_kinds = rows_of([d[0] for d in result.description], result.fetchall())
    if names != sql_names:
        return f"columns {names} vs {sql_names}"
    if kinds != sql_kinds:
        return f"types { {c: (kinds[c], sql_kinds[c]) for c in names if kinds[c] != sql_kinds[c]} }"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows vs {len(sql_rows)}: {sorted(set(rows) ^ set(sql_rows))[:4]}"
    different = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    if different:
        only, sql_only = sorted(set(rows) - set(sql_rows)), sorted(set(sql_rows) - set(rows))
        return f"{len(different)} of {len(rows)} differ: {only[:3]} vs {sql_only[:3]}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from touchline.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls = connect(sf_dir), oracle_sql()
    wanted = sys.argv[1:]
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                verdict = compare(df, sqls[name], connection) or "ok"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception:
            verdict = "FAILED " + traceback.format_exc()[-1500:]
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
