"""Stars that prune, meet buckets, or follow snapshots; code tables; batch-time quantiles."""

import glob
import os
from bisect import bisect_right
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_plans import plan
from tillflow import schemas
from tillflow.operators.calendar import build_dim_date
from tillflow.operators.dimensions import build_dim_store
from tillflow.operators.lookup import decoded, repeated_codes
from tillflow.plans.daily import load_dates
from tillflow.plans.health import day_sketches, read_day_sketches, store_day_sketches, time_quantiles
from tillflow.plans.star import FACT_SUMS, in_force, sales_of_dates, star_bucketed, star_in_force, validity
from tillflow.sinks.buckets import one_per_id, write_bucketed
from tillflow.sinks.gold import replace_days, write_days
from tillflow.sources.gold import read_gold

SOLD = {"invoice_line_no": "1-1", "product_id": "p1", **dict.fromkeys(FACT_SUMS, 2)}


@pytest.fixture
def facts(make):
    def build(*rows):
        full = [{**SOLD, "product_id": product, "partition": day, "date_key": date(int(day[:4]), int(day[4:6]), int(day[6:]))} for product, day in rows]
        typed = [{k: float(v) if schemas.FACT_SALES[k].dataType.simpleString() == "double" else v for k, v in row.items()} for row in full]
        return make(schemas.FACT_SALES, typed)

    return build


@pytest.fixture
def products(make):
    def build(*rows):
        return make(schemas.DIM_PRODUCT, [{"id": i, "partition": day, "vendor_name": vendor} for i, day, vendor in rows])

    return build


@pytest.mark.parametrize("write", [write_days, replace_days])
def test_only_days_of_the_dates_are_opened(spark, lake, facts, write):
    write(facts(("p1", "20240331"), ("p1", "20240401"), ("p2", "20240630"), ("p1", "20240701")), lake.gold("fact_liquor_sales"), "rebalance")
    load_dates(spark, lake, "2024-01-01", "2024-12-31")
    fact, dates = read_gold(spark, lake, "fact_liquor_sales"), read_gold(spark, lake, "dim_iowa_date")
    # Files of other days are no Parquet any more: whoever opens one fails.
    for day in ("20240331", "20240701"):
        for file in glob.glob(f"{lake.gold('fact_liquor_sales')}/**/partition={day}/*.parquet", recursive=True):
            with open(file, "w") as broken:
                broken.write("broken")
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    found = sales_of_dates(fact, dates, "quarter = 2")
    assert "dynamicpruning" in plan(found)
    assert rows_of(found, "partition") == [("20240401",), ("20240630",)]
    with pytest.raises(Exception):
        fact.collect()


def test_dates_that_are_no_files_give_the_same(spark, lake, facts):
    fact = facts(("p1", "20240331"), ("p1", "20240401"))
    found = sales_of_dates(fact, build_dim_date(spark, "2024-01-01", "2024-12-31"), "quarter = 2")
    assert rows_of(found, "partition") == [("20240401",)]


def test_bucketed_star_has_no_exchange_before_the_sums(spark, facts, products, tmp_path):
    fact = facts(("p1", "20240101"), ("p2", "20240101"), ("p1", "20240102"), (None, "20240102"), ("p9", "20240102"))
    dim = one_per_id(products(("p1", "20240101", "b"), ("p1", "20240101", "a"), ("p2", "20240101", None), ("p3", "20240101", "c")))
    write_bucketed(fact, "bucketed_fact", "product_id", 4, str(tmp_path / "fact"))
    write_bucketed(dim, "bucketed_product", "id", 4, str(tmp_path / "product"))
    try:
        result = star_bucketed(spark.table("bucketed_fact"), spark.table("bucketed_product"), ["product_vendor_name"])
        text = plan(result)
        below = text[text.index("partial_sum") :]
        assert "SortMergeJoin" in below and "Exchange" not in below and "Broadcast" not in text
        got = {r.product_vendor_name: (r.sales_lines, r.unmatched_products) for r in result.where("product_vendor_name IS NOT NULL").collect()}
        none = result.where("product_vendor_name IS NULL").agg(F.sum("sales_lines"), F.sum("unmatched_products")).first()
        assert got == {"a": (2, 0)} and tuple(none) == (3, 2)
        # A file a bucket at most, however many tasks wrote.
        assert len(glob.glob(str(tmp_path / "fact/*.parquet"))) <= 4
    finally:
        spark.sql("DROP TABLE bucketed_fact")
        spark.sql("DROP TABLE bucketed_product")


def test_snapshot_in_force_against_brute_force(facts, products):
    rng = np.random.default_rng(11)
    days = [f"2024{m:02}{d:02}" for m in (1, 2) for d in range(1, 29)]
    sold = [(f"p{rng.choice([0, 0, 0, 0, 1, 2, 3])}", str(rng.choice(days))) for _ in range(300)]
    listed = [(f"p{rng.integers(0, 3)}", str(rng.choice(days)), f"v{rng.integers(0, 5)}") for _ in range(25)]
    listed += [(i, day, f"{vendor}x") for i, day, vendor in listed[:6]] + [("p0", days[-1], "v9")]
    by_id = {}
    for i, day, vendor in sorted(listed, reverse=True):
        by_id.setdefault(i, {})[day] = vendor  # the least of a day comes last
    want = []
    for i, day in sold:
        held = sorted(by_id.get(i, {}))
        at = bisect_right(held, day) - 1
        want.append((i, day, held[at] if at >= 0 else None, by_id[i][held[at]] if at >= 0 else None))
    got = in_force(facts(*sold), products(*listed), "product", ["vendor_name"])
    assert rows_of(got, "product_id", "partition", "product_as_of", "product_vendor_name") == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert any(w[2] is None for w in want) and any(w[2] == w[1] for w in want) and any(w[2] and w[2] < w[1] for w in want)
    sums = star_in_force(facts(*sold), products(*listed), ["product_vendor_name"]).collect()
    assert sum(r.sales_lines for r in sums) == 300 and sum(r.unmatched_products for r in sums) == sum(w[2] is None for w in want)


def test_validity(products):
    rows = validity(products(("p1", "20240131", "b"), ("p1", "20240131", "a"), ("p1", "20240301", "c"), ("p2", "20240101", None)))
    assert rows_of(rows, "id", "valid_from", "valid_to", "vendor_name") == [
        ("p1", "20240131", "20240229", "a"), ("p1", "20240301", None, "c"), ("p2", "20240101", None, None),
    ]


@pytest.mark.parametrize("size", [1 << 20, 0])
def test_code_table(spark, make, size):
    rows = spark.createDataFrame([("IA", 1), ("ia", 2), (None, 3), ("XX", 4), ("OR", 5)], "code STRING, name INT")
    codes = spark.createDataFrame([("IA", "Iowa"), ("IA", "Old Iowa"), ("OR", None), (None, "nowhere"), ("CO", "Colorado")], "code STRING, name STRING")
    got = decoded(rows, "code", codes, size)
    assert got.columns == rows.columns and rows_of(got) == rows_of(rows.replace("IA", "Iowa", "code"))
    assert rows_of(repeated_codes(codes)) == [("IA", 2, 2)]
    stores = make(schemas.RAW_STORE, [{"store": "1", "state": "IA", "partition": "20240101"}, {"store": "2", "state": "Q", "partition": "20240101"}])
    assert rows_of(build_dim_store(stores, states=codes), "id", "state") == [("1", "Iowa"), ("2", "Q")]


def test_quantiles_out_of_stored_day_sketches(spark, tmp_path):
    rng = np.random.default_rng(5)
    times = rng.lognormal(1, 1, 6000)
    rows = [("app", f"t{n % 2}", f"2024-01-0{n % 3 + 1} 10:00:00", float(t)) for n, t in enumerate(times)] + [("app", "t0", "2024-01-01 11:00:00", None)]
    log = spark.createDataFrame(rows, "app_name STRING, table_name STRING, at STRING, processing_time_seconds DOUBLE")
    log = log.withColumn("batch_start_time", F.col("at").cast("timestamp"))
    root = str(tmp_path / "sketches")
    assert store_day_sketches(log, root, "2024-01-03") == ["20240101", "20240102"]
    assert store_day_sketches(log, root, "2024-01-04") == ["20240103"]  # days are sketched once
    sketches = read_day_sketches(spark, root)
    assert rows_of(sketches, "batches") == [(1000,)] * 6
    for row in time_quantiles(sketches, [0.5, 0.95, 0.99]).collect():
        values = np.sort([t for n, t in enumerate(times) if f"t{n % 2}" == row.table_name])
        assert row.batches == 3000 and abs(np.searchsorted(values, row.seconds) / 3000 - row.rank) < 0.02
    one_day = time_quantiles(read_day_sketches(spark, root, "20240102", "20240102"), [0.5], ["app_name"]).collect()
    assert [(r.app_name, r.batches) for r in one_day] == [("app", 2000)]
    assert day_sketches(log.limit(0)).count() == 0
