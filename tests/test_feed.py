"""Staged feeds of the registered queries: what they hold, and what they shuffle."""

import glob
import gzip
from collections import Counter
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import feed
from tests.test_streaming import shuffles, shuffles_left
from tillflow.session import session_conf

TABLES = {
    "nation": ("n_nationkey INT, n_name STRING", [(0, "NORTH"), (1, "SOUTH")]),
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
        [(5, "Shop 5", 1, 1.0, "TOYS"), (6, "Shop 6", 0, 2.0, None)],
    ),
    "supplier": ("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE", [(1, "West", 0, 1.0)]),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
        [(3, "bolt", "Brand#3", "LARGE", 7, 9.5), (4, None, "Brand#4", "SMALL", None, 2.0)],
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP",
        [(10, 5, datetime(2024, 12, 1)), (11, 6, datetime(2024, 12, 2)), (12, 99, datetime(2024, 12, 2))],
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE",
        [(10, 3, 1, 2, 2.0, 19.0), (10, 4, 1, 1, 1.0, 2.0), (11, 3, 1, 1, 4.0, 38.0), (11, 3, 1, 1, 4.0, 38.0), (11, 8, 1, 2, 4.0, 1.0), (12, 3, 1, 1, 1.0, 9.5)],
    ),
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


@pytest.fixture
def shuffled(spark):
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_messages_hold_the_lines_of_an_order(spark, tables):
    held = spark.read.parquet(feed.staged(spark, tables, "messages"))
    texts = sorted(bytes(row.value).decode() for row in held.collect())
    lines = [[line.split(",")[3] for line in text.split("\n")] for text in texts]
    assert lines == [["10-1", "10-2"], ["11-1", "11-1"]]


def test_messages_are_collected_where_the_join_leaves_them(spark, tables, shuffled):
    with session_conf(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"}):
        text = plan(feed.messages(spark, tables))
    collected, _, joined = text.partition("SortMergeJoin")
    assert "SortAggregate" in collected and "Exchange" not in collected and "Sort [" not in collected
    # Stores meet the orders; the lines are shuffled by part, supplier and order only.
    assert text.count("Exchange hashpartitioning(l_") == 3


def test_landed_sales_shuffle_what_lines_are_made_from(spark, tables, shuffled):
    frame = feed.landed_sales(spark, tables)
    text = plan(frame)
    assert "liquor_sales" in text.partition("Exchange")[0]
    assert "liquor_sales" not in text.partition("Exchange")[2]
    assert Counter(map(tuple, frame.collect())) == Counter(map(tuple, feed.raw_sales(spark, tables).collect()))


@pytest.mark.parametrize("what", ["rd_liquor_sales", "one_day"])
def test_staged_lines_are_packed(spark, tables, what):
    root = feed.staged(spark, tables, what).removeprefix("file:")
    files = glob.glob(f"{root}/**/rd_liquor_sales/partition=*/*.csv.gz", recursive=True)
    lines = [line.split(",")[3] for file in files for line in gzip.open(file, "rt").read().splitlines()]
    assert sorted(lines) == ["10-1", "10-2", "11-1", "11-1"]


def test_all_cores_can_read_a_file_of_messages(spark, tmp_path):
    """A batch takes a few files: their row groups are what its tasks share."""
    text = F.concat_ws(",", F.sha2(F.col("id").cast("string"), 512), F.sha2((F.col("id") + 0.5).cast("string"), 512))
    rows = spark.range(0, 120_000, numPartitions=1).select(text.cast("binary").alias("value"))
    feed.write_messages(rows, f"{tmp_path}/messages")
    (file,) = glob.glob(f"{tmp_path}/messages/*.parquet")
    assert pq.ParquetFile(file).num_row_groups >= 3
    assert spark.read.parquet(f"{tmp_path}/messages").exceptAll(rows).isEmpty()


def test_shuffle_files_go_with_the_staging(spark, tables, shuffled):
    before = shuffles(spark)
    feed.staged(spark, tables, "messages")
    assert not shuffles_left(spark, before)
