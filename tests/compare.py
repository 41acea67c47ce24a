"""Run registered queries beside their checks and report differences.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, build, sql, sf_dir, inspect=None):
    """None when equal, else a text that says how they differ."""
    df = build(spark, sf_dir)
    if inspect:
        inspect(df)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got is not None else "no rows"
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}"
    if len(got) != len(want):
        extra, lost = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"rows {len(got)} vs {len(want)}; only here {extra}; only check {lost}"
    if got != want:
        extra, lost = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"values differ ({len(set(got) - set(want))}); {kinds}; here {extra}; check {lost}"
    if not got:
        return "EMPTY on both sides"
    check_kinds = {d[0]: str(d[1]) for d in cur.description}
    odd = {
        k: (kinds[k], check_kinds[k])
        for k in kinds
        if {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}.get(kinds[k])
        != check_kinds[k] and not (check_kinds[k] in ("STRING", "NUMBER", "BOOL"))
    }
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from stowage.session import build_session

    args = sys.argv[1:]
    sf = "0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or list(queries):
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], checks.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001 - report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{bad} bad of {len(args or queries)}")
