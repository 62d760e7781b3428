"""Run every query beside its SQL and report differences: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

TYPES = {"tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> tuple[str | None, int]:
    """What differs between a Spark result and a DuckDB result (None if nothing), and the number of rows."""
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}", len(ours)
    types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    wrong = {c: (types[c], described[c]) for c in columns if types[c] != described[c]}
    if wrong:
        return f"types {wrong}", len(ours)
    pick = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in pick) for r in result.fetchall()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}", len(ours)
    for a, b in zip(sorted(map(repr, ours)), sorted(map(repr, theirs))):
        if a != b:
            return f"{columns}\n    {a}\n    {b}", len(ours)
    return None, len(ours)


def main() -> int:
    from statline.session import build_session
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = duck(folder), oracle_sql(), 0
    known = queries()
    assert set(sql) <= set(known), set(sql) - set(known)
    for name in sys.argv[2:] or known:
        start = time.time()
        try:
            found, rows = difference(known[name](spark, folder), con, sql[name]) if name in sql else ("no SQL", 0)
        except Exception as error:
            found, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {rows} rows {time.time() - start:.1f}s {found or ''}", flush=True)
    print("differences:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
