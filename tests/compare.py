"""Run registered queries next to their SQL and compare whole results.

    python -m tests.compare 0.01 [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        raise TypeError("decimals must be cast to double")
    return value


def _sorted(rows):
    return sorted((tuple(_cell(v) for v in row) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both results are identical, else a description of the first mismatch.

    Values and Python types have to agree exactly; only the row order is free.
    """
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    expected = _sorted([[row[names.index(c)] for c in order] for row in cursor.fetchall()])
    if sorted(spark_df.columns) != order:
        return f"columns {sorted(spark_df.columns)} != {order}"
    actual = _sorted([[row[c] for c in order] for row in spark_df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for mine, theirs in zip(actual, expected):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{order}\n  spark {mine}\n  sql   {theirs}"
    return None


def main() -> int:
    import __spark_entry__ as driver
    from procurelens.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session("compare", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, statements = connect(folder), driver.oracle_sql()
    failed = 0
    for name, query in driver.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = difference(df, con, statements[name]) if name in statements else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} "
              f"{time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
