import hashlib
import os
import time
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import rows_of, sales_line
from tillflow import schemas
from tillflow.operators.dimensions import build_dim_store
from tillflow.operators.facts import build_fact_sales
from tillflow.plans.backfill import backfill
from tillflow.plans.daily import (
    PRODUCT,
    SALES,
    STORE,
    EmptyInput,
    TableJob,
    load_dates,
    load_day,
    run_daily,
)
from tillflow.sinks.gold import write_day, write_days, write_table
from tillflow.sources.gold import read_gold, read_gold_days, rows_per_day

STORE_LINE = '{0},Shop {0},A,"1, Main St",Ames,IA,50010,POINT (-93.6 41.6),2001-01-01'
PRODUCT_LINE = "{0},Vodka,Clear,v1,North,750,6,1,,80,2020-01-31,u,s,4.0,24.0,6.0,2001-01-01"


def put_sales(put_csv, day, *stores):
    lines = [sales_line(store=s, process_date=f"{day[:4]}-{day[4:6]}-{day[6:]}") for s in stores]
    put_csv("rd_liquor_sales", day, lines)


def fingerprint(folder):
    marks = {}
    for path, _, files in os.walk(folder):
        for name in files:
            full = os.path.join(path, name)
            with open(full, "rb") as file:
                marks[full] = hashlib.sha256(file.read()).hexdigest()
    return marks


def statuses(report):
    return {r["partition"]: (r["status"], r["rows"]) for r in report.collect()}


# ---- one day


def test_load_day(spark, lake, put_csv):
    put_sales(put_csv, "20241201", "a", "b")
    put_sales(put_csv, "20241202", "c")
    report = load_day(spark, lake, SALES, "20241201")
    assert report.rows == 2
    assert report.path.endswith("fact_liquor_sales/partition=20241201")
    assert "2 rows written to " in report.text()
    fact = read_gold(spark, lake, SALES.gold)
    assert fact.schema.names == schemas.FACT_SALES.names
    assert rows_of(fact, "store_id", "partition") == [("a", "20241201"), ("b", "20241201")]
    load_day(spark, lake, SALES, "20241202")
    before = fingerprint(f"{lake.gold(SALES.gold)}/partition=20241202")
    put_sales(put_csv, "20241201", "z")
    load_day(spark, lake, SALES, "20241201")
    fact = read_gold(spark, lake, SALES.gold)
    assert rows_of(fact, "store_id") == [("c",), ("z",)]
    assert fingerprint(f"{lake.gold(SALES.gold)}/partition=20241202") == before


def test_day_in_the_file_gives_way_to_the_folder(spark, lake, put_csv):
    put_csv("rd_liquor_sales", "20241201", [sales_line() + ",19990101"])
    load_day(spark, lake, SALES, "20241201")
    assert rows_of(read_gold(spark, lake, SALES.gold), "partition") == [("20241201",)]


def test_missing_day_fails(spark, lake, put_csv):
    put_sales(put_csv, "20241201", "a")
    for job in (SALES, PRODUCT):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            load_day(spark, lake, job, "20241202")


def test_empty_day(spark, lake, put_csv):
    put_csv("rd_liquor_store", "20241201", [STORE_LINE.format(1)])
    assert load_day(spark, lake, STORE, "20241201").rows == 1
    put_csv("rd_liquor_store", "20241201", [])
    assert load_day(spark, lake, STORE, "20241201", on_empty="skip").rows == 0
    assert read_gold(spark, lake, STORE.gold).count() == 1
    assert load_day(spark, lake, STORE, "20241201").rows == 0
    assert read_gold(spark, lake, STORE.gold).count() == 0
    put_csv("rd_liquor_sales", "20241201", [])
    with pytest.raises(EmptyInput):
        load_day(spark, lake, SALES, "20241201")


@pytest.mark.parametrize("layout, files", [("scan", 3), ("rebalance", 1), (1, 1), (2, 2)])
def test_file_layout(spark, lake, put_csv, layout, files):
    for n in range(3):
        put_csv("rd_liquor_store", "20241201", [STORE_LINE.format(n)] * 50, f"part-{n}.csv")
    spark.conf.set("spark.sql.files.openCostInBytes", "64MB")
    try:
        assert load_day(spark, lake, STORE, "20241201", layout=layout).rows == 150
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    folder = f"{lake.gold(STORE.gold)}/partition=20241201"
    assert sum(name.endswith(".parquet") for name in os.listdir(folder)) == files


def test_write_reports(spark, tmp_path):
    frame = spark.range(10).selectExpr("id", "CAST(id % 3 AS STRING) AS partition")
    report = write_days(frame, str(tmp_path / "t"))
    assert (report.rows, report.days) == (10, ["0", "1", "2"])
    report = write_days(frame.where("partition = '1'"), str(tmp_path / "t"), "rebalance")
    assert (report.rows, report.days) == (3, ["1"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10
    assert write_day(frame.where("false"), str(tmp_path / "t"), "1").rows == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7
    assert write_table(frame, str(tmp_path / "u")).rows == 10


def test_load_dates(spark, lake):
    assert load_dates(spark, lake).rows == 4018
    assert read_gold(spark, lake, "dim_iowa_date").schema.names == schemas.DIM_DATE.names


# ---- daily run


def put_all(put_csv, day):
    put_csv("rd_liquor_product", day, [PRODUCT_LINE.format(n) for n in range(3)])
    put_csv("rd_liquor_store", day, [STORE_LINE.format(n) for n in range(2)])
    put_sales(put_csv, day, "1", "1", "0", "7")


def test_run_daily(spark, lake, put_csv):
    put_all(put_csv, "20241201")
    log = run_daily(spark, lake, "20241201")
    assert log.schema == schemas.RUN_LOG
    steps = [tuple(r) for r in log.select("step", "try_number", "status", "rows").collect()]
    assert steps == [
        ("product_daily", 1, "succeed", 3),
        ("store_daily", 1, "succeed", 2),
        ("sales_daily", 1, "succeed", 4),
    ]


def test_run_daily_stops_at_the_first_failure(spark, lake, put_csv):
    put_all(put_csv, "20241201")
    put_csv("rd_liquor_product", "20241202", [PRODUCT_LINE.format(1)])
    log = run_daily(spark, lake, "20241202", retries=1, retry_wait=0)
    tries = [tuple(r) for r in log.select("step", "try_number", "status").collect()]
    assert tries == [
        ("product_daily", 1, "succeed"),
        ("store_daily", 1, "failed"),
        ("store_daily", 2, "failed"),
    ]
    assert "PATH_NOT_FOUND" in log.where("status = 'failed'").first()["error"]


def test_run_daily_retries(spark, lake, put_csv):
    put_all(put_csv, "20241201")
    calls = []

    def fails_once(raw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("not yet")
        return build_dim_store(raw)

    job = TableJob("flaky", STORE.raw, STORE.gold, fails_once, "write", "write")
    log = run_daily(spark, lake, "20241201", (job,), retry_wait=0)
    assert [(r["status"], r["rows"]) for r in log.collect()] == [("failed", None), ("succeed", 2)]


def test_run_daily_time_limit(spark, lake, put_csv):
    put_all(put_csv, "20241201")

    def slow(raw):
        spark.range(10**14).selectExpr("max(xxhash64(id))").collect()
        return build_dim_store(raw)

    job = TableJob("slow", STORE.raw, STORE.gold, slow, "write", "write")
    started = time.monotonic()
    log = run_daily(spark, lake, "20241201", (job,), retries=0, time_limit=3)
    assert time.monotonic() - started < 40
    assert log.first()["status"] == "failed"


# ---- backfill


def test_backfill_equals_daily_runs(spark, lake, put_csv, tmp_path):
    days = ["20241230", "20241231", "20250102"]
    for n, day in enumerate(days):
        put_sales(put_csv, day, *"abc"[: n + 1])
        put_csv("rd_liquor_store", day, [STORE_LINE.format(n)])
        put_csv("rd_liquor_product", day, [PRODUCT_LINE.format(n)] * 2)
    for job in (SALES, STORE, PRODUCT):
        for day in days:
            load_day(spark, lake, job, day)
        daily = rows_of(read_gold(spark, lake, job.gold))
        for _ in range(2):
            report = backfill(spark, lake, job, "20241229", "20250103", layout="rebalance")
            found = statuses(report)
            assert rows_of(read_gold(spark, lake, job.gold)) == daily
        assert list(found) and {d for d, (s, _) in found.items() if s == "ok"} == set(days)
        quiet = {"20241229", "20250101", "20250103"}
        assert all(found[day] == ("no_data", 0) for day in quiet)
    counts = rows_of(rows_per_day(spark, lake, SALES.gold, "20241231", "20250102"))
    assert counts == [("20241231", 2), ("20250102", 3)]
    one = read_gold_days(spark, lake, SALES.gold, "20241231", "20241231")
    assert rows_of(one, "store_id", "partition") == [("a", "20241231"), ("b", "20241231")]


def test_backfill_leaves_other_days_alone(spark, lake, put_csv):
    put_sales(put_csv, "20241130", "a")
    load_day(spark, lake, SALES, "20241130")
    before = fingerprint(f"{lake.gold(SALES.gold)}/partition=20241130")
    put_sales(put_csv, "20241201", "b")
    backfill(spark, lake, SALES, "20241201", "20241203")
    assert fingerprint(f"{lake.gold(SALES.gold)}/partition=20241130") == before


def test_backfill_of_empty_days(spark, lake, put_csv):
    for day in ("20241201", "20241202", "20241203"):
        put_sales(put_csv, day, "a")
        put_csv("rd_liquor_store", day, [STORE_LINE.format(1)])
        load_day(spark, lake, SALES, day)
        load_day(spark, lake, STORE, day)
    put_csv("rd_liquor_sales", "20241202", [])
    put_csv("rd_liquor_store", "20241202", [])
    sales = statuses(backfill(spark, lake, SALES, "20241201", "20241204"))
    assert sales["20241202"] == ("no_data", 0)
    assert read_gold(spark, lake, SALES.gold).count() == 3
    stores = statuses(backfill(spark, lake, STORE, "20241201", "20241204"))
    assert stores["20241202"] == ("emptied", 0)
    assert stores["20241204"] == ("no_data", 0)
    assert rows_of(read_gold(spark, lake, STORE.gold), "partition") == [("20241201",), ("20241203",)]
    with pytest.raises(EmptyInput):
        backfill(spark, lake, SALES, "20241201", "20241204", on_empty="raise")


def test_backfill_without_any_day(spark, lake):
    found = statuses(backfill(spark, lake, SALES, "20241201", "20241202"))
    assert found == {"20241201": ("no_data", 0), "20241202": ("no_data", 0)}
    with pytest.raises(ValueError):
        backfill(spark, lake, SALES, "20241202", "20241201")


def test_backfill_isolates_a_failing_day(spark, lake, put_csv):
    days = [f"2024120{n}" for n in range(1, 8)]
    for day in days:
        put_sales(put_csv, day, "a", "b")
    put_csv("rd_liquor_sales", "20241205", ["this is not gzip"], "part-1.csv.gz")
    report = backfill(spark, lake, SALES, days[0], days[-1])
    found = statuses(report)
    assert found.pop("20241205") == ("failed", 0)
    assert set(found.values()) == {("ok", 2)}
    assert report.where("status = 'failed'").first()["error"]
    assert read_gold(spark, lake, SALES.gold).count() == 12


def test_one_builder_serves_both(spark, lake, put_csv):
    put_sales(put_csv, "20241201", "a")
    assert SALES.build is build_fact_sales


def test_backfill_reports_a_fault_of_the_whole_run_at_once(spark, lake, put_csv):
    days, calls = [f"202412{n:02}" for n in range(1, 17)], []
    for day in days:
        put_sales(put_csv, day, "a")

    def broken(raw):
        calls.append(1)
        raise RuntimeError("no rights")

    job = TableJob("broken", SALES.raw, SALES.gold, broken, "raise", "skip")
    found = statuses(backfill(spark, lake, job, days[0], days[-1]))
    assert set(found.values()) == {("failed", 0)} and len(found) == 16 and len(calls) == 3


def test_a_failed_write_leaves_the_old_day(spark, lake, put_csv):
    put_sales(put_csv, "20241201", "a", "b", "c")
    load_day(spark, lake, SALES, "20241201")
    before = fingerprint(f"{lake.gold(SALES.gold)}/partition=20241201")
    bad = spark.range(0, 4, 1, 2).selectExpr("if(id < 3, id, raise_error('broken')) AS store_id")
    with pytest.raises(Exception, match="broken"):
        write_day(bad, lake.gold(SALES.gold), "20241201")
    assert fingerprint(f"{lake.gold(SALES.gold)}/partition=20241201") == before
    assert read_gold(spark, lake, SALES.gold).count() == 3


def test_lenient_dates_in_the_jobs(spark, lake, put_csv):
    lines = [sales_line(process_date=text) for text in ("2024-1-2", "2024-01-03 08:00:00", "2024-01-123")]
    put_csv("rd_liquor_sales", "20241201", lines)
    put_csv("rd_liquor_store", "20241201", [STORE_LINE.format(1)])
    put_csv("rd_liquor_product", "20241201", [PRODUCT_LINE.format(1).replace("2020-01-31", "2020-1-31")])
    load_day(spark, lake, SALES, "20241201")
    assert rows_of(read_gold(spark, lake, SALES.gold), "date_key") == [(None,)] * 3
    days = [(None,), (date(2024, 1, 2),), (date(2024, 1, 3),)]
    load_day(spark, lake, SALES.lenient(), "20241201")
    assert rows_of(read_gold(spark, lake, SALES.gold), "date_key") == days
    backfill(spark, lake, SALES.lenient(), "20241201", "20241201")
    assert rows_of(read_gold(spark, lake, SALES.gold), "date_key") == days
    run_daily(spark, lake, "20241201", tuple(job.lenient() for job in (PRODUCT, STORE, SALES)), retries=0)
    assert rows_of(read_gold(spark, lake, PRODUCT.gold), "listdate") == [(date(2020, 1, 31),)]
    assert rows_of(read_gold(spark, lake, SALES.gold), "date_key") == days
