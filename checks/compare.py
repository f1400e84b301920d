"""Run registered queries next to their SQL and compare all values as multisets.

    python -m checks.compare [sf_dir] [query …]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tillflow.session import spark_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def _value(value):
    if isinstance(value, float):
        return repr(value)
    return str(value.normalize()) if isinstance(value, Decimal) else value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the Spark result and the SQL result, or None."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    expected, found = _rows(names, cursor.fetchall()), _rows(result.columns, result.collect())
    if expected == found:
        return None
    missing, extra = list((expected - found).items())[:3], list((found - expected).items())[:3]
    return f"{found.total()} rows against {expected.total()}; missing {missing}; extra {extra}"


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark: SparkSession = spark_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in arguments[1:] or list(QUERIES):
        started = time.monotonic()
        try:
            result = QUERIES[name](spark, sf_dir)
            problem = differences(result, con, ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {error}"
        bad += problem is not None
        print(f"{name:32} {time.monotonic() - started:6.1f}s  {problem or 'ok'}"[:1500], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
