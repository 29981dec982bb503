"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    for names, kind in (
        (("bigint", "hugeint", "int64"), "bigint"), (("integer", "int"), "int"), (("double",), "double"),
        (("varchar", "string"), "string"), (("date",), "date"), (("boolean",), "boolean"),
    ):
        if name in names:
            return "hugeint" if name == "hugeint" else kind
    return name


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple((r[i] + 0.0 if isinstance(r[i], float) else r[i]) for i in order)) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if schema and rows agree, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: _kind(str(d[1])) for d in found.description}
    expected = _rows(names, found.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    spark_kinds = {c: _kind(t) for c, t in df.dtypes}
    if spark_kinds != kinds:
        differ = sorted(set(spark_kinds.items()) ^ set(kinds.items()))
        return f"schema: {differ[:8]}"
    if len(actual) != len(expected):
        return f"rows: {len(actual)} against {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first: {wrong[0][0][:300]} against {wrong[0][1][:300]}"
    return None


def main(argv: list[str]) -> int:
    from cartwise.session import build_session
    from checks.oracle import statements
    from checks.spark_queries import registry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, queries = connect(sf_dir), statements(), registry()
    bad = 0
    for name in argv[1:] or queries:
        if name not in sqls:
            print(f"---- {name}: no SQL")
            continue
        began = time.time()
        problem = compare(queries[name](spark, sf_dir), con, sqls[name])
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
