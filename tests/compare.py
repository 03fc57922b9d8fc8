"""Compare registered queries with their SQL on DuckDB: names, types, rows and values.

Usage: python tests/compare.py [folder] [query name part ...] [spark setting=value ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        files = Path(folder, f"{name}.parquet")
        where = f"{files}/*.parquet" if files.is_dir() else str(files)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{where}'")
    return con


def kind(type_name: str) -> str:
    """Engine type names brought to one spelling."""
    plain = type_name.lower()
    same = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}
    return same.get(plain, plain)


def ordered(rows, names):
    index = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in index) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str, run, sql: str | None) -> str:
    """Empty text when equal, else the first difference."""
    df = run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if rows else "no rows"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: kind(str(d[1])) for d in rel.description}
    expected = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    mine = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (mine[c], types[c]) for c in mine if mine[c] != types[c]}
    if wrong:
        return f"types {wrong}"
    for a, b in zip(ordered(rows, df.columns), ordered(expected, names)):
        if a != b:
            return f"first difference: {a} against {b}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemill.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    settings = dict(a.split("=", 1) for a in args if "=" in a)
    args = [a for a in args if "=" not in a]
    spark = local_session("compare", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, run, sqls.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
