"""Run registered queries and their SQL side by side: ``python tests/compare.py <sf_dir> [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows: list[tuple], columns: list[str]) -> list[str]:
    """Rows with columns sorted by name, as sorted text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL; None if nothing does."""
    df = query(spark, sf_dir)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = canonical(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours != theirs:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"{len(ours)} vs {len(theirs)} rows, e.g. {sorted(a)[:2]} vs {sorted(b)[:2]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from tickloom.registry import ORACLES, QUERIES

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connection(sys.argv[1])
    print("without SQL:", sorted(set(QUERIES) - set(ORACLES)), "without query:", sorted(set(ORACLES) - set(QUERIES)))
    bad = 0
    for name in sys.argv[2:] or sorted(ORACLES):
        start = time.time()
        try:
            found = difference(session, duck, QUERIES[name], ORACLES[name], sys.argv[1])
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f} {(found or '')[:1200]}", flush=True)
    print("failed:", bad)
