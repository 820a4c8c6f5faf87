"""Run registered queries and their SQL texts side by side and compare rows exactly.

usage: python tests/check_oracle.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

sys.path.insert(0, "/root/repo")

import __spark_entry__ as entry  # noqa: E402
from statloom.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{directory}/{t}.parquet')")
    return con


def differences(spark_df, con, sql: str) -> str | None:
    columns = sorted(spark_df.columns)
    rows = spark_df.select(*columns).collect()
    relation = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({sql})")
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    types = dict(zip(relation.columns, [str(t).lower() for t in relation.types]))
    same = {"int": "integer", "string": "varchar"}
    wrong = {c: (spark_types[c], types[c]) for c in columns if same.get(spark_types[c], spark_types[c]) != types[c]}
    if wrong:
        return f"types {wrong}"
    key = lambda r: tuple((v is None, str(type(v)), v) for v in r)
    ours = sorted((tuple(r) for r in rows), key=key)
    theirs = sorted(relation.fetchall(), key=key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    return f"{len(bad)} of {len(ours)} rows differ, e.g. {bad[0]}" if bad else None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    names = sys.argv[2:]
    spark = local_session()
    con = connect(directory)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, run in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, directory)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                verdict = "ok" if problem is None else f"DIFF {problem}"
            else:
                verdict = f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            traceback.print_exc(limit=-4)
            verdict = f"ERROR {str(e)[:1500]}"
        if verdict.startswith(("DIFF", "ERROR")):
            failed.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
