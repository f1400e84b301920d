"""Registered queries. Each takes (spark, sf_dir) and runs over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed
from tillflow.files import delete_folder
from tillflow.functions.codes import STATE_NAMES
from tillflow.lake import Lake
from tillflow.operators.calendar import build_dim_date, date_spine, with_calendar
from tillflow.operators.dimensions import build_dim_product, build_dim_store
from tillflow.operators.facts import build_fact_sales
from tillflow.operators.totals import COMMON_KEYS, GRAIN_KEYS, all_totals, merge_deltas, totals
from tillflow.plans.backfill import backfill, backfill_versions
from tillflow.plans.catalog import register_table
from tillflow.plans.daily import PRODUCT, SALES, STORE, TableJob, load_dates, load_day, run_daily
from tillflow.plans.health import log_health, read_day_sketches, store_day_sketches, time_quantiles
from tillflow.plans.star import sales_of_dates, star_bucketed, star_in_force, star_sales
from tillflow.schemas import FACT_SALES, SALES_LINE
from tillflow.session import work_folder
from tillflow.sinks.buckets import one_per_id, write_bucketed
from tillflow.sinks.gold import replace_days
from tillflow.sinks.logs import compact_batch_log, read_batch_log
from tillflow.sources.gold import read_gold, read_gold_days
from tillflow.sources.messages import parquet_messages, parse_sales
from tillflow.sources.raw import read_raw_days
from tillflow.streaming.compaction import compact_landing, drop_compacted
from tillflow.streaming.current import current_totals, drop_folded, fold, late_totals, publish_view, state_totals
from tillflow.streaming.landing import REJECTS, TABLE, land_batch, start_landing
from tillflow.streaming.levels import drop_levelled, fold_days
from tillflow.streaming.totals import TotalsStore, start_totals
from tillflow.versions import commit, read_manifest, read_versioned, vacuum

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def money(rows: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order; two decimals do not."""
    rounded = {name: F.round(name, 2).cast("decimal(18,2)") for name in columns}
    return rows.withColumns(rounded)


TOTAL_MONEY = [
    "tot_cost_dollars",
    "tot_sale_dollars",
    "tot_profit_dollars",
    "sale_liters",
    "sale_gallons",
]
STAR_MONEY = ["sale_dollars", "cost_dollars", "gross_profit", "sale_liters", "sale_gallons"]


# ---- fact and dimensions


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_sales(feed.raw_sales(spark, sf_dir, stores=False, vendors=False))


@query
def fact_sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(feed.staged(spark, sf_dir, SALES.raw))
    start, end = feed.day_range(spark, sf_dir)
    return build_fact_sales(read_raw_days(spark, lake, SALES.raw, start, end))


@query
def fact_sales_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates with short months and days, with a time, or with a digit too many (no date)."""
    date, kind = F.col("process_date"), F.col("hour_id").cast("int") % 4
    short = F.regexp_replace(date, "-0", "-")
    written = (
        F.when(kind == 0, short)
        .when(kind == 1, F.concat(date, F.lit(" 08:00:00")))
        .when(kind == 2, F.concat(date, F.lit("5")))
        .otherwise(date)
    )
    raw = feed.raw_sales(spark, sf_dir, stores=False, vendors=False)
    return SALES.lenient().build(raw.withColumn("process_date", written))


@query
def store_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores with the names of states out of a code table, one code of which stands there twice."""
    names = [*STATE_NAMES.items(), ("IA", "Iowa (old)"), (None, "nowhere")]
    codes = spark.createDataFrame(names, "code STRING, name STRING")
    return build_dim_store(feed.raw_store(spark, sf_dir), states=codes)


@query
def fact_profit_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = build_fact_sales(feed.raw_sales(spark, sf_dir, stores=False, vendors=False))
    by_day = fact.groupBy("partition").agg(
        F.count(F.lit(1)).alias("sales_lines"), F.sum("gross_profit").alias("gross_profit")
    )
    return money(by_day, "gross_profit")


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_product(feed.raw_product(spark, sf_dir), feed.LANDING_DAY)


@query
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_store(feed.raw_store(spark, sf_dir), feed.LANDING_DAY)


def _loaded_day(spark: SparkSession, sf_dir: str, job: TableJob, layout: str | int) -> DataFrame:
    raw, gold = Lake(feed.staged(spark, sf_dir, "one_day")), Lake(work_folder(spark))
    load_day(spark, LakePair(raw, gold), job, feed.LANDING_DAY, layout=layout)
    return read_gold_days(spark, gold, job.gold, feed.LANDING_DAY, feed.LANDING_DAY)


class LakePair(Lake):
    """Raw zone of one lake, gold zone of another: staged input is shared, output is per run."""

    def __init__(self, raw: Lake, gold: Lake):
        super().__init__(gold.root)
        object.__setattr__(self, "_raw", raw)

    def raw(self, table: str) -> str:
        return self._raw.raw(table)


@query
def dim_product_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_day(spark, sf_dir, PRODUCT, "rebalance")


@query
def dim_store_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_day(spark, sf_dir, STORE, "rebalance")


@query
def fact_sales_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales landed on one day, loaded and read back."""
    return _loaded_day(spark, sf_dir, SALES, "scan")


def _calendar(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    """Every day from the first to the last order, with the orders of the day."""
    orders = feed.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("full_date"))
    per_day = days.groupBy("full_date").agg(F.count(F.lit(1)).alias("orders"))
    spine = date_spine(days, "full_date").join(per_day, "full_date", "left")
    return with_calendar(spine.fillna(0, ["orders"]), rule)


@query
def dim_date_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar(spark, sf_dir, "calendar")


@query
def dim_date_iso_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar(spark, sf_dir, "iso_week")


@query
def dim_date_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date table of both rules as written, with the orders of the day 25 years before."""
    days = feed.table(spark, sf_dir, "orders").select(F.add_months(F.to_date("o_orderdate"), 300).alias("full_date"))
    per_day = days.groupBy("full_date").agg(F.count(F.lit(1)).alias("orders"))
    tables = []
    for rule in ("calendar", "iso_week"):
        lake = Lake(work_folder(spark))
        load_dates(spark, lake, rule=rule)
        dates = read_gold(spark, lake, "dim_iowa_date")
        tables.append(dates.join(per_day, "full_date", "left").fillna(0, ["orders"]).withColumn("rule", F.lit(rule)))
    return tables[0].unionByName(tables[1])


# ---- totals


@query
def f001_store_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = feed.raw_sales(spark, sf_dir, vendors=False)
    return money(totals(sales, "f001_store_tot_sales"), *TOTAL_MONEY)


@query
def f002_vendor_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = feed.raw_sales(spark, sf_dir, stores=False)
    return money(totals(sales, "f002_vendor_tot_sales"), *TOTAL_MONEY)


@query
def f003_product_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = feed.raw_sales(spark, sf_dir, stores=False, vendors=False)
    return money(totals(sales, "f003_product_tot_sales"), *TOTAL_MONEY)


@query
def all_totals_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(all_totals(feed.raw_sales(spark, sf_dir)), *TOTAL_MONEY)


# ---- streams


# As many message files a batch as the job this replaces reads messages; not a share of the data.
FILES_PER_TRIGGER = 4


def _drained(
    spark: SparkSession,
    sf_dir: str,
    store: TotalsStore,
    checkpoint: str,
    mode: str = "delta",
    output: str = "update",
    new_checkpoint: str = "refuse",
    late_after: str | None = None,
) -> None:
    rows = feed.staged(spark, sf_dir, "messages")
    messages = parquet_messages(spark, rows, max_files_per_trigger=FILES_PER_TRIGGER)
    start_totals(
        messages, store, checkpoint, mode, output, every=None, state_partitions=8, new_checkpoint=new_checkpoint, late_after=late_after
    ).awaitTermination()


def _streamed(
    spark: SparkSession, sf_dir: str, mode: str = "delta", output: str = "update"
) -> TotalsStore:
    work = work_folder(spark)
    store = TotalsStore(f"{work}/totals")
    _drained(spark, sf_dir, store, f"{work}/checkpoint", mode, output)
    return store


def _stream_result(
    spark: SparkSession, sf_dir: str, table: str, mode: str = "delta", output: str = "update"
) -> DataFrame:
    store = _streamed(spark, sf_dir, mode, output)
    return money(current_totals(spark, store, table, mode, output), *TOTAL_MONEY)


@query
def f001_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_result(spark, sf_dir, "f001_store_tot_sales")


@query
def f002_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_result(spark, sf_dir, "f002_vendor_tot_sales")


@query
def f003_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_result(spark, sf_dir, "f003_product_tot_sales")


@query
def f001_stream_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_result(spark, sf_dir, "f001_store_tot_sales", "state", "update")


@query
def f002_stream_state_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_result(spark, sf_dir, "f002_vendor_tot_sales", "state", "complete")


@query
def stream_current_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all but the newest batch were folded into the base."""
    store = _streamed(spark, sf_dir)
    fold(spark, store)
    return money(current_totals(spark, store, "f001_store_tot_sales"), *TOTAL_MONEY)


@query
def stream_restart_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drained, folded, and drained again from the start through a new checkpoint: counted once."""
    work = work_folder(spark)
    store = TotalsStore(f"{work}/totals")
    _drained(spark, sf_dir, store, f"{work}/first")
    fold(spark, store)
    _drained(spark, sf_dir, store, f"{work}/second", new_checkpoint="replace")
    drop_folded(spark, store)
    return money(current_totals(spark, store, "f003_product_tot_sales"), *TOTAL_MONEY)


@query
def f001_state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals read out of the query's state; nothing that it published is left."""
    work = work_folder(spark)
    store, checkpoint = TotalsStore(f"{work}/totals"), f"{work}/checkpoint"
    _drained(spark, sf_dir, store, checkpoint, "state")
    delete_folder(spark, store.snapshots)
    return money(state_totals(spark, checkpoint, "f001_store_tot_sales"), *TOTAL_MONEY)


@query
def f001_stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timely and late totals add up to the totals of all messages, which come in no order of time."""
    work = work_folder(spark)
    store = TotalsStore(f"{work}/totals")
    _drained(spark, sf_dir, store, f"{work}/checkpoint", late_after="30 days")
    table = "f001_store_tot_sales"
    both = current_totals(spark, store, table).unionByName(late_totals(spark, store, table))
    return money(merge_deltas(both, COMMON_KEYS + GRAIN_KEYS[table]), *TOTAL_MONEY)


@query
def stream_levelled_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded by day twice, with the folded batches gone: totals out of the days and the newest batch."""
    store = _streamed(spark, sf_dir)
    fold_days(spark, store, up_to=0)
    fold_days(spark, store)
    drop_levelled(spark, store)
    return money(current_totals(spark, store, "f001_store_tot_sales"), *TOTAL_MONEY)


@query
def totals_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current totals as a catalog view over a Parquet folder, read in SQL."""
    store, view = _streamed(spark, sf_dir), f"totals_{uuid.uuid4().hex}"
    publish_view(spark, store, "f002_vendor_tot_sales", view)
    result = spark.sql(f"SELECT * FROM {view}")
    spark.sql(f"DROP VIEW {view}")
    return money(result, *TOTAL_MONEY)


@query
def stream_message_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages built from each sales line: blank lines, CRLF, bad numbers, short and long lines, and
    NULL messages (remainder 4), which give no row."""
    odd = F.col("sale_bottles") % 5
    bottles = F.concat(F.col("sale_bottles"), F.when(odd == 3, ".0").otherwise(""))
    sales = feed.raw_sales(spark, sf_dir).withColumns({"odd": odd, "sale_bottles": bottles})
    sales = sales.select("odd", F.to_csv(F.struct(*SALES_LINE.names)).alias("line"))
    line = F.col("line")
    broken = (
        F.when(F.col("odd") == 0, F.concat(line, F.lit("\r\n"), line, F.lit("\n\n")))
        .when(F.col("odd") == 1, F.concat(line, F.lit(",more,fields\n")))
        .when(F.col("odd") == 2, F.substring_index(line, ",", 4))
        .when(F.col("odd") == 3, line)
    )
    messages = sales.select(broken.cast("binary").alias("value"))
    return parse_sales(messages).select(
        "process_date", "hour_id", "invoice_line_no", "address", "pack", "sale_bottles", "sale_gallons"
    )


def _log_sums(log: DataFrame) -> DataFrame:
    return log.groupBy("app_name", "table_name", "status").agg(
        F.sum("record_count").alias("records")
    )


@query
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages logged per table."""
    return _log_sums(read_batch_log(spark, _streamed(spark, sf_dir).log))


@query
def stream_progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with state, after the log was compacted by day."""
    path = _streamed(spark, sf_dir, "state").log
    compact_batch_log(spark, path, "9999-01-01")
    return _log_sums(read_batch_log(spark, path))


def _landed(spark: SparkSession, sf_dir: str) -> Lake:
    """Lines of Brand#1 have no date and lines of Brand#2 lack fields: both are rejected."""
    work = work_folder(spark)
    lake = Lake(f"{work}/lake")
    sales = feed.raw_sales(spark, sf_dir)
    date = F.when(F.col("category") != "Brand#1", F.col("process_date")).otherwise("no date")
    sales = sales.withColumn("process_date", date)
    line = F.to_csv(F.struct(*SALES_LINE.names))
    short = F.substring_index(line, ",", 7)
    line = F.when(F.col("category") == "Brand#2", short).otherwise(line)
    value = F.concat(line, F.lit("\r\n")).cast("binary").alias("value")
    feed.write_messages(sales.select(value), f"{work}/messages")
    messages = parquet_messages(spark, f"{work}/messages", max_files_per_trigger=FILES_PER_TRIGGER)
    start_landing(messages, lake, f"{work}/checkpoint", every=None).awaitTermination()
    return lake


@query
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _landed(spark, sf_dir)
    start, end = feed.day_range(spark, sf_dir)
    columns = ["partition", "invoice_line_no", "date", "store", "itemno", "address"]
    return read_raw_days(spark, lake, TABLE, start, end).select(*columns, "sale_bottles", "sale_dollars")


@query
def raw_landing_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed days compacted and their batches dropped; then a batch of small sales lands late."""
    lake = _landed(spark, sf_dir)
    compact_landing(spark, lake, TABLE, "99999999", up_to=10**6)
    drop_compacted(spark, lake, TABLE, grace_seconds=-60)
    sales = feed.raw_sales(spark, sf_dir).where("sale_bottles = 1")
    late = sales.select(F.to_csv(F.struct(*SALES_LINE.names)).cast("binary").alias("value"))
    land_batch(late, 10**6 + 1, lake)
    start, end = feed.day_range(spark, sf_dir)
    columns = ["partition", "invoice_line_no", "date", "store", "itemno", "address"]
    return read_raw_days(spark, lake, TABLE, start, end).select(*columns, "sale_bottles", "sale_dollars")


@query
def raw_landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = spark.read.text(_landed(spark, sf_dir).raw(REJECTS))
    return rejects.select(F.split("value", ",")[3].alias("invoice_line_no"))


# ---- backfill and daily run


def _backfilled(spark: SparkSession, sf_dir: str, job: TableJob) -> tuple[Lake, DataFrame]:
    lake = LakePair(Lake(feed.staged(spark, sf_dir, job.raw)), Lake(work_folder(spark)))
    start, end = feed.day_range(spark, sf_dir)
    return lake, backfill(spark, lake, job, start, end)


@query
def backfill_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _backfilled(spark, sf_dir, SALES)
    return read_gold(spark, lake, SALES.gold)


@query
def backfill_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _backfilled(spark, sf_dir, PRODUCT)
    return read_gold(spark, lake, PRODUCT.gold)


@query
def backfill_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _backfilled(spark, sf_dir, STORE)
    return read_gold(spark, lake, STORE.gold)


@query
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every day from the first order to the last."""
    _, report = _backfilled(spark, sf_dir, STORE)
    return report.select("partition", "status", "rows")


@query
def empty_day_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every day of a job that keeps active stores: days with none of them are emptied."""
    active = replace(STORE, build=lambda raw: build_dim_store(raw).where("status = 'active'"))
    lake = LakePair(Lake(feed.staged(spark, sf_dir, STORE.raw)), Lake(work_folder(spark)))
    report = backfill_versions(spark, lake, active, *feed.day_range(spark, sf_dir))
    return report.select("partition", "status", "rows")


@query
def day_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day as of two manifests: all sales, and after a reload that found large sales only in the
    days of the newest year. Days that the reload left empty are not there; superseded days stay readable."""
    root = f"{work_folder(spark)}/fact"
    fact = _fact(spark, sf_dir)
    replace_days(fact, root, "rebalance")
    year = feed.day_range(spark, sf_dir)[1][:4]
    asked = [day for day in read_manifest(spark, root).days if day.startswith(year)]
    replace_days(fact.where(F.col("partition").startswith(year) & (F.col("sale_bottles") > 30)), root, "rebalance", asked)
    vacuum(spark, root)
    days = [
        read_versioned(spark, root, FACT_SALES, manifest=read_manifest(spark, root, number)).withColumn("version", F.lit(number))
        for number in (1, 2)
    ]
    sums = [F.count(F.lit(1)).alias("sales_lines"), F.sum("sale_bottles").alias("sale_bottles")]
    return days[0].unionByName(days[1]).groupBy("version", "partition").agg(*sums)


@query
def backfill_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every day of a second backfill: one day's raw files came anew in between."""
    raw = Lake(feed.staged(spark, sf_dir, STORE.raw))
    lake, (start, end) = LakePair(raw, Lake(work_folder(spark))), feed.day_range(spark, sf_dir)
    backfill_versions(spark, lake, STORE, start, end)
    # The staged files are only read: that the last day came from others is entered by hand.
    commit(spark, lake.gold(STORE.gold), lambda now: replace(now, days=now.days | {end: replace(now.days[end], source="other files")}))
    report = backfill_versions(spark, lake, STORE, start, end, changed_only=True)
    return report.select("partition", "status", "rows")


@query
def daily_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = LakePair(Lake(feed.staged(spark, sf_dir, "one_day")), Lake(work_folder(spark)))
    log = run_daily(spark, lake, feed.LANDING_DAY, retries=0)
    return log.select("run_date", "step", "try_number", "status", "rows")


# ---- serving


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_sales(feed.raw_sales(spark, sf_dir, stores=False, vendors=False))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date table over the days that were ordered on."""
    first, last = feed.day_range(spark, sf_dir)
    return build_dim_date(spark, *(f"{day[:4]}-{day[4:6]}-{day[6:]}" for day in (first, last)))


@query
def star_month_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months by product category, with the newest product snapshot."""
    products = build_dim_product(feed.raw_product(spark, sf_dir))
    by = ["year_month", "product_category"]
    result = star_sales(
        _fact(spark, sf_dir), by, _dates(spark, sf_dir), products=products, snapshot="latest"
    )
    return money(result, *STAR_MONEY)


@query
def star_store_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States, with the store snapshot of each sale's own day; sales of stores in debt match none."""
    stores = build_dim_store(feed.solvent_stores(spark, sf_dir))
    by = ["store_state", "store_status"]
    return money(star_sales(_fact(spark, sf_dir), by, stores=stores), *STAR_MONEY)


@query
def star_same_day_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors, with the product snapshot of each sale's own day, every row of which comes twice."""
    products = build_dim_product(feed.sold_products(spark, sf_dir))
    by = ["product_vendor_name"]
    return money(star_sales(_fact(spark, sf_dir), by, products=products.union(products)), *STAR_MONEY)


@query
def star_quarter_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second quarters by month, over the backfilled fact and a written date table: the scan opens the
    days of those quarters only."""
    lake, _ = _backfilled(spark, sf_dir, SALES)
    first, last = (f"{day[:4]}-{day[4:6]}-{day[6:]}" for day in feed.day_range(spark, sf_dir))
    load_dates(spark, lake, first, last)
    dates = read_gold(spark, lake, "dim_iowa_date")
    fact = sales_of_dates(read_gold(spark, lake, SALES.gold), dates, "quarter = 2")
    return money(star_sales(fact, ["year_month"], dates), *STAR_MONEY)


@query
def star_in_force_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors and day of the snapshot in force: products are listed in the first ten days of a month
    only, with what was sold on them, and some were sold before they were ever listed."""
    snapshots = feed.sold_products(spark, sf_dir).where(F.substring("partition", 7, 2) <= "10")
    products = build_dim_product(snapshots)
    result = star_in_force(_fact(spark, sf_dir), products, ["product_vendor_name", "product_as_of"])
    return money(result, *STAR_MONEY)


@query
def star_bucketed_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories and vendors, out of a fact and a product table in sixteen buckets each."""
    tables = {kind: f"{kind}_{uuid.uuid4().hex}" for kind in ("fact", "product")}
    products = one_per_id(build_dim_product(feed.raw_product(spark, sf_dir)))
    work = work_folder(spark)
    write_bucketed(_fact(spark, sf_dir), tables["fact"], "product_id", 16, f"{work}/fact")
    write_bucketed(products, tables["product"], "id", 16, f"{work}/product")
    fact, dim = (spark.table(tables[kind]) for kind in ("fact", "product"))
    result = money(star_bucketed(fact, dim, ["product_category", "product_vendor_name"]), *STAR_MONEY)
    result.write.parquet(f"{work}/result")
    for name in tables.values():
        spark.sql(f"DROP TABLE {name}")  # its files stay: it is external
    return spark.read.schema(result.schema).parquet(f"{work}/result")


@query
def star_weekend_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekends and holidays by vendor and state: all three dimensions at once."""
    products = build_dim_product(feed.raw_product(spark, sf_dir))
    stores = build_dim_store(feed.raw_store(spark, sf_dir))
    by = ["is_weekend", "is_holiday", "product_vendor_name", "store_state"]
    fact = _fact(spark, sf_dir)
    return money(
        star_sales(fact, by, _dates(spark, sf_dir), products, stores, snapshot="latest"), *STAR_MONEY
    )


@query
def gold_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfilled fact as an external table, queried in SQL."""
    lake, _ = _backfilled(spark, sf_dir, SALES)
    name = f"fact_{uuid.uuid4().hex}"
    register_table(spark, name, FACT_SALES, lake.gold(SALES.gold))
    result = spark.sql(
        f"""SELECT substr(partition, 1, 4) AS sale_year, product_id, count(*) AS sales_lines,
                   sum(sale_dollars) AS sale_dollars, sum(gross_profit) AS gross_profit
            FROM {name} GROUP BY 1, 2"""
    )
    folder = work_folder(spark)
    result.write.parquet(folder)  # the day folders are looked up in the catalog when it is read
    spark.sql(f"DROP TABLE {name}")  # its files stay: it is external
    return money(spark.read.schema(result.schema).parquet(folder), "sale_dollars", "gross_profit")


@query
def log_health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a batch log: the user is the app, the event type the table."""
    events = feed.table(spark, sf_dir, "events")
    log = events.select(
        F.concat(F.lit("app "), F.col("user_id").cast("string")).alias("app_name"),
        F.col("props").alias("table_name"),
        F.col("value").alias("processing_time_seconds"),
        F.col("event_id").alias("record_count"),
        F.when(F.col("event_type") == "error", "error").otherwise("succeed").alias("status"),
    )
    health = log_health(log, max_mean_seconds=30.0007, max_seconds=200.0, max_errors=1)
    return health.withColumns(
        {
            "mean_seconds": F.round("mean_seconds", 6).cast("decimal(18,6)"),
            "max_seconds": F.round("max_seconds", 2).cast("decimal(18,2)"),
        }
    )


@query
def log_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the events' values as batch times, out of stored sketches per day, and whether each
    lies within two percent of its rank among all values."""
    events = feed.table(spark, sf_dir, "events").select(
        F.lit("app").alias("app_name"),
        F.col("event_type").alias("table_name"),
        F.col("ts").cast("timestamp").alias("batch_start_time"),
        F.col("value").alias("processing_time_seconds"),
    )
    root = f"{work_folder(spark)}/sketches"
    store_day_sketches(events, root, "9999-01-01")
    found = time_quantiles(read_day_sketches(spark, root), [0.5, 0.95, 0.99])
    found = found.select("table_name", "batches", "rank", "seconds")
    value = F.col("processing_time_seconds")
    below, up_to = F.avg((value < F.col("seconds")).cast("int")), F.avg((value <= F.col("seconds")).cast("int"))
    ranked = events.join(found, "table_name").groupBy("table_name", "batches", "rank")
    near = (below.alias("below"), up_to.alias("up_to"))
    close = F.col("rank").between(F.col("below") - 0.02, F.col("up_to") + 0.02)
    return ranked.agg(*near).select("table_name", "batches", "rank", close.alias("close"))
