from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SALES_DEFAULTS, rows_of
from tillflow import schemas
from tillflow.operators.calendar import build_dim_date, date_spine, with_calendar
from tillflow.operators.dimensions import build_dim_product, build_dim_store
from tillflow.operators.facts import build_fact_sales
from tillflow.operators.totals import (
    COMMON_KEYS,
    GRAIN_KEYS,
    MEASURES,
    all_totals,
    latest_snapshot,
    merge_deltas,
    pick_totals,
    totals,
)


def types(frame):
    return [(f.name, f.dataType) for f in frame.schema.fields]


def expected_types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_fact_sales(make):
    raw = make(
        schemas.RAW_SALES,
        [
            {"invoice_line_no": "a"},
            {"invoice_line_no": "a", "sale_bottles": -2},
            {"invoice_line_no": "b", "state_bottle_cost": None},
            {"invoice_line_no": "c", "process_date": "2024-1-2"},
        ],
        SALES_DEFAULTS,
    )
    fact = build_fact_sales(raw)
    assert types(fact) == expected_types(schemas.FACT_SALES)
    columns = ["invoice_line_no", "date_key", "cost_dollars", "gross_profit"]
    assert rows_of(fact, *columns) == [
        ("a", date(2024, 12, 1), -8.0, 20.0),
        ("a", date(2024, 12, 1), 8.0, 4.0),
        ("b", date(2024, 12, 1), None, None),
        ("c", None, 8.0, 4.0),
    ]
    lenient = build_fact_sales(raw, lenient_dates=True).where("invoice_line_no = 'c'")
    assert lenient.first()["date_key"] == date(2024, 1, 2)


def test_dim_product(make):
    raw = make(
        schemas.RAW_PRODUCT,
        [
            {"itemno": "1", "proof": 80.0, "listdate": "2020-02-30", "date": "2001-01-01"},
            {"itemno": "2", "proof": None, "listdate": "2020-02-29", "date": None},
        ],
        {"partition": "20241201", "category_name": "Vodka", "vendor_no": "v"},
    )
    dim = build_dim_product(raw, "20241202")
    assert types(dim) == expected_types(schemas.DIM_PRODUCT)
    assert rows_of(dim, "id", "ABV", "listdate", "update_date") == [
        ("1", 0.4, None, date(2024, 12, 2)),
        ("2", None, date(2020, 2, 29), date(2024, 12, 2)),
    ]
    own_day = build_dim_product(raw).select("update_date").distinct()
    assert rows_of(own_day) == [(date(2024, 12, 1),)]


def test_dim_store(make):
    raw = make(
        schemas.RAW_STORE,
        [
            {"store": "1", "store_status": "A", "state": "IA", "store_address": "POINT (-93.6 41.6)"},
            {"store": "2", "store_status": "X", "state": "ia", "store_address": "POINT (-93 41)"},
        ],
        {"partition": "20241201"},
    )
    dim = build_dim_store(raw, "20241201")
    assert types(dim) == expected_types(schemas.DIM_STORE)
    assert rows_of(dim, "id", "status", "state", "latitude", "longitude") == [
        ("1", "active", "Iowa", 41.6, -93.6),
        ("2", "X", "ia", None, None),
    ]


# ---- calendar


def flag(frame, column):
    return {r["full_date"].isoformat(): r[column] for r in frame.collect()}


def test_date_table(spark):
    dim = build_dim_date(spark)
    assert types(dim) == expected_types(schemas.DIM_DATE)
    rows = dim.orderBy("full_date").collect()
    assert len(rows) == 4018
    gaps = {(b["full_date"] - a["full_date"]).days for a, b in zip(rows, rows[1:])}
    assert gaps == {1}
    assert sum(r["is_weekend"] == "weekend" for r in rows) == 1148
    first = dim.where("full_date = '2021-01-01'").first().asDict()
    assert first == {
        "full_date": date(2021, 1, 1),
        "date_key": "2021-01-01",
        "day_of_week": "Friday",
        "day_of_month": "01",
        "month": "01",
        "month_name": "January",
        "quarter": 1,
        "year": "2021",
        "year_month": "202101",
        "is_weekend": "weekday",
        "is_holiday": "yes",
        "week_of_year": 53,
    }


@pytest.mark.parametrize(
    "rule, count, yes, no",
    [
        ("iso_week", 77, ["2025-01-13"], ["2025-01-20", "2025-02-17", "2025-11-27"]),
        ("calendar", 99, ["2025-01-20", "2025-02-17", "2025-11-27"], ["2025-01-13"]),
    ],
)
def test_holidays(spark, rule, count, yes, no):
    holidays = flag(build_dim_date(spark, rule=rule), "is_holiday")
    assert list(holidays.values()).count("yes") == count
    always = ["2025-05-26", "2025-09-01", "2025-07-04", "2025-11-11", "2025-12-25", "2025-01-01"]
    assert {holidays[day] for day in yes + always} == {"yes"}
    assert {holidays[day] for day in no} == {"no"}


def test_unknown_holiday_rule(spark):
    with pytest.raises(ValueError):
        build_dim_date(spark, rule="none")


def test_date_range_ends(spark):
    assert build_dim_date(spark, "2024-02-28", "2024-03-01").count() == 3
    assert build_dim_date(spark, "2024-03-01", "2024-02-28").count() == 0


def test_date_spine(spark):
    dates = spark.sql("SELECT explode(array(date'2024-02-27', date'2024-03-01', NULL)) AS d")
    spine = with_calendar(date_spine(dates, "d").withColumn("extra", F.lit(1)))
    assert spine.columns == [*schemas.DIM_DATE.names, "extra"]
    assert spine.count() == 4
    assert date_spine(dates.where("false"), "d").count() == 0


# ---- totals

LINES = [
    {},
    {"hour_id": "09", "sale_bottles": -2, "sale_dollars": -12.0},
    {"name": "Other", "vendor_name": None, "im_desc": None},
    {"name": None, "city": None, "category_name": None, "im_desc": None},
    {"name": "Corner Shop", "store": "s2"},
    {"state_bottle_cost": None},
    {"process_date": "bad", "state_bottle_cost": None},
]


def test_store_totals(make):
    sales = make(schemas.RAW_SALES, LINES, SALES_DEFAULTS)
    result = totals(sales, "f001_store_tot_sales")
    assert types(result) == expected_types(schemas.totals_schema("f001_store_tot_sales"))
    shop = result.where("store_name = 'Corner Shop' AND hour_id = '08' AND prd_id IS NOT NULL")
    row = shop.first()
    # Two stores of one name and city are one row; the line without a cost counts its sales.
    assert row["sale_bottles"] == 6
    assert (row["tot_cost_dollars"], row["tot_sale_dollars"]) == (16.0, 36.0)
    assert row["tot_profit_dollars"] == 20.0
    undated = result.where("prd_id IS NULL").first()
    assert undated["tot_cost_dollars"] is None and undated["tot_profit_dollars"] is None
    assert undated["tot_sale_dollars"] == 12.0


def test_one_pass_gives_the_same_totals(make):
    sales = make(schemas.RAW_SALES, LINES, SALES_DEFAULTS)
    everything = all_totals(sales)
    for table in schemas.TOTAL_GRAINS:
        picked = pick_totals(everything, table)
        assert types(picked) == expected_types(schemas.totals_schema(table))
        assert rows_of(picked) == rows_of(totals(sales, table))


def test_grand_totals_agree(make):
    sales = make(schemas.RAW_SALES, LINES, SALES_DEFAULTS)
    grand = [F.sum(name) for name in MEASURES if name != "tot_profit_dollars"]
    sums = {tuple(totals(sales, table).agg(*grand).first()) for table in schemas.TOTAL_GRAINS}
    assert len(sums) == 1


def test_merged_deltas_equal_the_whole(make):
    sales = make(schemas.RAW_SALES, LINES, SALES_DEFAULTS)
    parts = [make(schemas.RAW_SALES, [line], SALES_DEFAULTS) for line in LINES]
    for table, keys in GRAIN_KEYS.items():
        deltas = totals(parts[0], table)
        for part in parts[1:]:
            deltas = deltas.unionByName(totals(part, table))
        assert rows_of(merge_deltas(deltas, COMMON_KEYS + keys)) == rows_of(totals(sales, table))


def test_latest_snapshot(make):
    table = "f002_vendor_tot_sales"
    first = totals(make(schemas.RAW_SALES, LINES[:2], SALES_DEFAULTS), table)
    second = totals(make(schemas.RAW_SALES, LINES[:4], SALES_DEFAULTS), table)
    both = first.withColumn("batch_id", F.lit(0)).unionByName(second.withColumn("batch_id", F.lit(1)))
    keys = COMMON_KEYS + GRAIN_KEYS[table]
    assert rows_of(latest_snapshot(both, keys)) == rows_of(second)
