"""Run registered queries against their checking SQL: python tests/check_queries.py [sf] [name...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, db, sql) -> str | None:
    """None when both sides agree, else what differs."""
    left_cols, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    right_cols, right = _rows(names, cursor.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    for c, t in df.dtypes:
        if _TYPES.get(t, t) != kinds[c]:
            return f"type of {c}: {t} != {kinds[c]}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"value {a} != {b}"
    return None


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    sf_dir = f"{DATA}/sf{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    if names and names[0].startswith("from:"):
        order = list(queries)
        names = order[order.index(names[0][5:]) :]
    spark, db, bad = session(), connect(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, db, oracles[name])
                status = "ok" if problem is None else problem
            else:
                status = f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            status = f"{type(e).__name__}: {str(e)[:600]}"
            problem = status
        if name in oracles and status != "ok" or "Error" in status or "Exception" in status:
            bad += 1
            print("BAD", end=" ")
        print(f"{name:26s} {time.time() - t:6.2f}s {status}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
