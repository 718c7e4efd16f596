"""Run queries in Spark and DuckDB and compare rows: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from barloom.session import local_session
from checks import oracle, queries


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in oracle.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str) -> tuple[int, str | None]:
    """Row count and a description of the first difference, None when equal."""
    df = queries.registry()[name](spark, sf)
    columns = sorted(df.columns)
    rows = [tuple(plain(v) for v in r) for r in df.select(*columns).collect()]
    sql = oracle.statements().get(name)
    if sql is None:
        return len(rows), None
    result = con.execute(sql)
    found = [d[0] for d in result.description]
    if sorted(found) != columns:
        return len(rows), f"columns {columns} against {sorted(found)}"
    kinds = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    off = {c: (t, kinds[c]) for c, t in df.dtypes if wanted.get(t) != kinds[c]}
    order = [found.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in order) for r in con.execute(sql).fetchall()]
    left, right = Counter(rows), Counter(expected)
    if left != right:
        extra, lost = left - right, right - left
        return len(rows), f"{len(rows)} rows against {len(expected)}; only Spark {list(extra)[:2]}; only SQL {list(lost)[:2]}"
    if off:
        return len(rows), f"types {off}"
    return len(rows), None


def main() -> None:
    sf, *names = sys.argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names or queries.registry():
        start = time.time()
        try:
            count, problem = difference(spark, con, name, sf)
        except Exception as error:  # report and go on with the other queries
            count, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        checked = "sql" if name in oracle.statements() else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:24} {count:8} {checked:4} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
