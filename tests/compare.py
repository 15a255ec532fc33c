"""Runs registered queries against their SQL and reports differences."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

EMPTY = "both are empty"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_normal(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark: SparkSession, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        if unwanted in plan:
            return f"plan has {unwanted}"
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    wanted = rows_of(names, result.fetchall())
    spark_types = dict(frame.dtypes)
    for name in names:
        short = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
        if short.get(spark_types[name]) != types[name]:
            return f"type of {name}: {spark_types[name]} against {types[name]}"
    if len(got) != len(wanted):
        return f"{len(got)} rows against {len(wanted)}"
    for left, right in zip(got, wanted, strict=True):
        if left != right:
            return f"{left} against {right}"
    return None if got else EMPTY


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    bad = 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in oracles or only and not any(name.startswith(o) for o in only):
            continue
        begun = time.time()
        try:
            problem = compare(spark, connection, query, oracles[name], sf_dir)
        except Exception as error:
            lines = traceback.format_exc().splitlines()
            problem = f"{type(error).__name__}: {str(error)[:1500]} @ {[l for l in lines if '/root/repo' in l or 'problem/repo' in l][-1:]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:26} {time.time() - begun:6.1f}s {problem or ''}", flush=True)
    print("differences:", bad, flush=True)


if __name__ == "__main__":
    main()
