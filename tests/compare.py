"""Compare every registered query with its SQL in an in-process database.

Run as a script: ``python tests/compare.py [folder] [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def normal_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, name, build, sql, sf_dir):
    """An error text, or None when rows and columns agree."""
    df = build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = normal_rows(got, df.columns), normal_rows(expected, columns)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        return f"{len(a)} rows vs {len(b)}; only spark {extra}; only sql {missing}"
    return None if a else "both empty"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            error = compare(spark, con, name, build, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - reported per query
            error = f"{type(e).__name__}: {str(e)[:700]}"
        bad += error is not None
        print(f"{'FAIL' if error else 'ok  '} {name} {time.time() - start:.2f}s {error or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
