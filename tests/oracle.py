"""Compare queries with their SQL twins: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("ionweave")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """Empty if schema and rows agree."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if got else ["no rows"]
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    out = []
    if sorted(df.columns) != sorted(rel.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(rel.columns)}")
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c, t in df.dtypes:
        if c in types and _SAME.get(t, t) != types[c]:
            out.append(f"type of {c}: {t} != {types[c]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        out.append(f"values: extra {extra}, missing {missing}")
    if not got:
        out.append("empty result")
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), database(sf)
    bad = 0
    for name in sys.argv[2:] or list(entry.queries()):
        start = time.time()
        try:
            found = differences(spark, con, name, sf)
        except Exception as e:  # report and go on to the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n    " if found else " ")
    print(f"{bad} failed")
