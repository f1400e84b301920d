"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as contract
from tests.conftest import sales_line
from tillflow import schemas
from tillflow.operators.calendar import build_dim_date
from tillflow.operators.dimensions import build_dim_store
from tillflow.operators.facts import build_fact_sales
from tillflow.operators.totals import all_totals, totals
from tillflow.plans.star import latest_day, star_sales
from tillflow.sources.messages import parse_sales

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(frame, capsys):
    frame.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def sales_path(spark, tmp_path):
    rows = [sales_line(store=f"s{n}") for n in range(4)]
    frame = spark.createDataFrame([(row,) for row in rows], "value STRING")
    for day in ("20241201", "20241202"):
        frame.write.text(f"{tmp_path}/sales/partition={day}")
    return f"{tmp_path}/sales"


@pytest.fixture
def raw(spark, sales_path):
    return spark.read.schema(schemas.RAW_SALES).csv(sales_path)


def test_fact_is_map_only_and_reads_what_it_needs(raw, capsys):
    text = formatted(build_fact_sales(raw.where("partition = '20241201'")), capsys)
    assert "Exchange" not in text and "Python" not in text
    assert re.search(r"PartitionFilters: \[.*partition.* = 20241201", text)
    columns = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "bottle_volume_ml" not in columns and "vendor_name" not in columns
    assert columns.count(":") == 9


def test_dimensions_have_no_python_and_no_shuffle(make):
    text = plan(build_dim_store(make(schemas.RAW_STORE, [{"store": "1"}]), "20241201"))
    assert "BatchEvalPython" not in text and "Exchange" not in text


def test_totals_sum_before_the_shuffle(raw):
    text = plan(totals(raw, "f001_store_tot_sales"))
    assert text.index("partial_sum") > text.index("Exchange")
    assert text.count("Exchange") == 1
    # The cost is summed once, though profit needs it as well.
    assert text.count("partial_sum((state_bottle_cost") == 1


def test_one_pass_scans_and_shuffles_once(raw):
    text = plan(all_totals(raw))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Expand" in text


def test_lines_are_parsed_once(spark):
    messages = spark.createDataFrame([(b"a,b",)], "value BINARY")
    assert plan(parse_sales(messages)).count("from_csv(") == 1


@pytest.fixture
def stores(spark, make, tmp_path):
    rows = make(schemas.DIM_STORE, [{"id": "s1", "partition": "20241201"}])
    rows.write.partitionBy("partition").parquet(f"{tmp_path}/stores")
    return spark.read.schema(schemas.DIM_STORE).parquet(f"{tmp_path}/stores")


def test_star_with_small_dimensions_shuffles_sums_only(spark, raw, stores):
    dates = build_dim_date(spark, "2024-12-01", "2024-12-31")
    text = plan(star_sales(build_fact_sales(raw), ["month", "store_state"], dates, stores=stores))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastHashJoin") == 2 and text.count("BroadcastExchange") == 2
    columns = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert any("store_state:string" in read and "city" not in read for read in columns)


def test_star_with_two_large_dimensions_can_split_hot_keys(spark, raw, stores, make):
    """Both sides of each join are plain shuffles, which is what Spark splits."""
    products = make(schemas.DIM_PRODUCT, [{"id": "p1", "partition": "20241201"}])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by = ["store_state", "product_category"]
        text = plan(star_sales(build_fact_sales(raw), by, products=products, stores=stores))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 2
    assert text.count("ENSURE_REQUIREMENTS") == 5
    for side in text.split("SortMergeJoin")[1:]:
        assert "HashAggregate" not in side


def test_latest_snapshot_prunes_folders(spark, tmp_path):
    days = spark.range(3).selectExpr("id", "CAST(20241201 + id AS STRING) AS partition")
    days.write.partitionBy("partition").parquet(f"{tmp_path}/dim")
    dim = spark.read.schema("id BIGINT, partition STRING").parquet(f"{tmp_path}/dim")
    newest = latest_day(dim)
    assert [r["id"] for r in newest.collect()] == [2]
    assert re.search(r"PartitionFilters: \[.*Subquery", plan(newest))


BATCH_QUERIES = [
    "fact_sales",
    "dim_product",
    "dim_store",
    "f001_store_totals",
    "all_totals_one_pass",
    "star_month_category",
    "star_store_state",
    "star_weekend_holiday",
    "log_health_report",
]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_registered_plans(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for unwanted in ("Cartesian", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in text
