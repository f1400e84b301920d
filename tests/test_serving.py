import uuid
from collections import defaultdict
from datetime import date, datetime

import pytest

from tests.conftest import SALES_DEFAULTS, rows_of, sales_line
from pyspark.sql.types import StructType

from tillflow import schemas
from tillflow.files import delete_folder
from tillflow.operators.calendar import build_dim_date
from tillflow.operators.facts import build_fact_sales
from tillflow.plans.catalog import register_gold, register_table
from tillflow.plans.daily import SALES, load_dates, load_day
from tillflow.plans.health import log_health, unhealthy
from tillflow.plans.star import repeated_keys, star_sales
from tillflow.session import session_conf

SALES_ROWS = [
    {"store": "s1", "itemno": "p1", "sale_bottles": 1},
    {"store": "s1", "itemno": "p1", "sale_bottles": 2},
    {"store": "s2", "itemno": "p2", "sale_bottles": 4},
    {"store": "s3", "itemno": "p1", "sale_bottles": 8},
    {"store": "s1", "itemno": "p9", "sale_bottles": 16, "process_date": "2024-12-02", "partition": "20241202"},
    {"store": None, "itemno": "p2", "sale_bottles": 32, "process_date": "bad", "partition": "20241202"},
]
STORES = [
    {"id": "s1", "state": "Iowa", "partition": "20241201"},
    {"id": "s2", "state": "Ohio", "partition": "20241201"},
    {"id": "s1", "state": "Utah", "partition": "20241202"},
]
PRODUCTS = [
    {"id": "p1", "category": "Vodka", "partition": "20241201"},
    {"id": "p2", "category": "Rum", "partition": "20241201"},
    {"id": "p2", "category": "Gin", "partition": "20241202"},
]


@pytest.fixture
def star(make):
    fact = build_fact_sales(make(schemas.RAW_SALES, SALES_ROWS, SALES_DEFAULTS))
    return fact, make(schemas.DIM_STORE, STORES), make(schemas.DIM_PRODUCT, PRODUCTS)


def brute_force(dims, key, attribute, snapshot):
    """Bottles, lines and unmatched lines by attribute, worked out row by row."""
    newest = max(d["partition"] for d in dims)
    out = defaultdict(lambda: [0, 0, 0])
    for row in SALES_ROWS:
        day = row.get("partition", "20241201") if snapshot == "same_day" else newest
        match = [d[attribute] for d in dims if d["id"] == row[key] and d["partition"] == day]
        for value in match or [None]:
            group = out[value]
            group[0] += row["sale_bottles"]
            group[1] += 1
            group[2] += not match
    return {value: tuple(sums) for value, sums in out.items()}


@pytest.fixture(params=["-1", "10m"])
def broadcast_bytes(spark, request):
    """Both ways Spark may join a dimension."""
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": request.param}):
        yield


SNAPSHOTS = ["same_day", "latest"]


@pytest.mark.parametrize("snapshot", SNAPSHOTS)
def test_store_star(star, snapshot, broadcast_bytes):
    fact, stores, _ = star
    result = star_sales(fact, ["store_state"], stores=stores, snapshot=snapshot).collect()
    found = {r["store_state"]: (r["sale_bottles"], r["sales_lines"], r["unmatched_stores"]) for r in result}
    assert found == brute_force(STORES, "store", "state", snapshot)


@pytest.mark.parametrize("snapshot", SNAPSHOTS)
def test_product_star(star, snapshot, broadcast_bytes):
    fact, _, products = star
    result = star_sales(fact, ["product_category"], products=products, snapshot=snapshot).collect()
    found = {
        r["product_category"]: (r["sale_bottles"], r["sales_lines"], r["unmatched_products"])
        for r in result
    }
    assert found == brute_force(PRODUCTS, "itemno", "category", snapshot)


def test_whole_star(spark, star, broadcast_bytes):
    fact, stores, products = star
    dates = build_dim_date(spark, "2024-12-01", "2024-12-31")
    by = ["day_of_week", "product_category", "store_state"]
    result = star_sales(fact, by, dates, products, stores)
    columns = [*by, "sale_bottles", "unmatched_dates", "unmatched_products", "unmatched_stores"]
    assert rows_of(result, *columns) == [
        (None, "Gin", None, 32, 1, 0, 1),
        ("Monday", None, "Utah", 16, 0, 1, 0),
        ("Sunday", "Rum", "Ohio", 4, 0, 0, 0),
        ("Sunday", "Vodka", None, 8, 0, 0, 1),
        ("Sunday", "Vodka", "Iowa", 3, 0, 0, 0),
    ]
    assert result.agg({"sale_dollars": "sum"}).first()[0] == 72.0


def test_a_repeated_key_counts_once(make, star):
    fact, _, _ = star
    stores = make(schemas.DIM_STORE, [*STORES, STORES[0], {**STORES[1], "state": "Maine"}])
    result = star_sales(fact, ["store_state"], stores=stores)
    assert rows_of(result, "store_state", "sales_lines")[1:] == [("Iowa", 2), ("Maine", 1), ("Utah", 1)]
    assert result.agg({"sale_dollars": "sum"}).first()[0] == 72.0
    found = rows_of(repeated_keys(stores, ["id", "partition"]))
    assert found == [("s1", "20241201", 2), ("s2", "20241201", 2)]


def test_group_by_key(star):
    fact, stores, _ = star
    result = star_sales(fact, ["store_id"], stores=stores)
    assert rows_of(result, "store_id", "sale_bottles")[1:] == [("s1", 19), ("s2", 4), ("s3", 8)]


def test_row_cap(star):
    fact, stores, _ = star
    result = star_sales(fact, ["store_state"], stores=stores, row_cap=2)
    assert [r["store_state"] for r in result.collect()] == [None, "Iowa"]


def test_unknown_snapshot(star):
    with pytest.raises(ValueError):
        star_sales(star[0], ["store_state"], stores=star[1], snapshot="newest")


def test_catalog(spark, lake, put_csv):
    put_csv("rd_liquor_sales", "20241201", [sales_line()])
    load_day(spark, lake, SALES, "20241201")
    load_dates(spark, lake, "2024-12-01", "2024-12-31")
    name = f"fact_{uuid.uuid4().hex}"
    register_table(spark, name, schemas.FACT_SALES, lake.gold(SALES.gold))
    assert spark.table(name).count() == 1
    put_csv("rd_liquor_sales", "20241202", [sales_line(process_date="2024-12-02")] * 2)
    load_day(spark, lake, SALES, "20241202")
    assert spark.table(name).count() == 1
    register_table(spark, name, schemas.FACT_SALES, lake.gold(SALES.gold))
    assert rows_of(spark.sql(f"SELECT partition, count(*) FROM {name} GROUP BY 1")) == [
        ("20241201", 1),
        ("20241202", 2),
    ]
    names = register_gold(spark, lake, prefix=f"x{uuid.uuid4().hex}_")
    joined = spark.sql(
        f"""SELECT d.month_name, sum(f.sale_bottles) FROM {names['fact_liquor_sales']} f
            JOIN {names['dim_iowa_date']} d ON f.date_key = d.full_date GROUP BY 1"""
    )
    assert rows_of(joined) == [("December", 6)]
    for table in [name, *names.values()]:
        spark.sql(f"DROP TABLE {table}")


def test_catalog_follows_folders_and_schemas(spark, lake, put_csv):
    for day in ("20241201", "20241202"):
        put_csv("rd_liquor_sales", day, [sales_line()])
        load_day(spark, lake, SALES, day)
    name, root = f"fact_{uuid.uuid4().hex}", lake.gold(SALES.gold)
    register_table(spark, name, schemas.FACT_SALES, root)
    assert spark.table(name).count() == 2
    delete_folder(spark, f"{root}/partition=20241201")
    register_table(spark, name, schemas.FACT_SALES, root)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["partition=20241202"]
    narrow = StructType([f for f in schemas.FACT_SALES.fields if f.name in ("store_id", "partition")])
    register_table(spark, name, narrow, root)
    assert spark.table(name).columns == ["store_id", "partition"] and spark.table(name).count() == 1
    spark.sql(f"DROP TABLE {name}")


def log_row(table, seconds, status="succeed", records=10):
    now = datetime(2024, 12, 1)
    return {
        "app_name": "app",
        "table_name": table,
        "batch_start_time": now,
        "batch_end_time": now,
        "processing_time_seconds": seconds,
        "record_count": records,
        "status": status,
    }


def test_log_health(make):
    rows = [log_row("slow", 50.0), log_row("slow", 100.0), log_row("fine", 1.0)]
    rows += [log_row("bad", 1.0), log_row("bad", 1.0, "error", 0)]
    log = make(schemas.STREAM_LOG, rows)
    columns = ["table_name", "batches", "records", "mean_seconds", "max_seconds", "errors", "alert"]
    assert rows_of(log_health(log), *columns) == [
        ("bad", 2, 10, 1.0, 1.0, 1, True),
        ("fine", 1, 10, 1.0, 1.0, 0, False),
        ("slow", 2, 20, 75.0, 100.0, 0, True),
    ]
    assert rows_of(unhealthy(log, max_mean_seconds=80.0), "table_name") == [("bad",)]
    assert rows_of(unhealthy(log, max_errors=1, max_seconds=99.0), "table_name") == [("slow",)]


def test_dates_join_on_the_date(spark, star):
    dates = build_dim_date(spark, "2024-12-01", "2024-12-31")
    assert dict(star[0].dtypes)["date_key"] == dict(dates.dtypes)["full_date"] == "date"
    assert dates.first()["full_date"] == date(2024, 12, 1)


def test_dimensions_are_dealt_by_key_before_the_least_is_found(spark, star, monkeypatch):
    from tillflow.plans import star as plans

    seen = []
    monkeypatch.setattr(plans, "_written", lambda rows: seen.append(rows) or rows)
    star_sales(star[0], ["store_state"], stores=star[1])
    text = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text and "Aggregate" not in text.partition("REPARTITION_BY_NUM")[2]


def test_many_folders_are_deleted(spark, tmp_path):
    from tillflow.files import delete_folders

    folders = [tmp_path / f"day={n}" for n in range(40)]
    for folder in folders:
        (folder / "deep").mkdir(parents=True)
    delete_folders(spark, [str(folder) for folder in folders[1:]])
    assert sorted(tmp_path.glob("day=*")) == [folders[0]]
