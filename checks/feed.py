"""The order tables as raw feeds of the lake, and raw zones staged from them.

A line item is a sales line, a customer a store, a part a product, a supplier a vendor. Joins are
left to Catalyst and AQE: no side is forced to broadcast, skewed joins are split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.lake import Lake
from tillflow.schemas import RAW_PRODUCT, RAW_SALES, RAW_STORE, SALES_LINE
from tillflow.session import TIDY, session_conf, work_folder

LANDING_DAY = "20240101"
#: What a task shuffles to write a file of messages; the file is about half as large.
MESSAGE_FILE = "128m"
#: Row groups of a file of messages: a batch takes a few files, and all cores can read them.
MESSAGE_GROUP = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _landing_day() -> Column:
    """Sales land on the day of their order."""
    return F.translate(F.to_date("o_orderdate").cast("string"), "-", "")


def _sold(spark: SparkSession, sf_dir: str, stores: bool = True, vendors: bool = True) -> DataFrame:
    """Sales lines as joined. The lines meet their order last: stores join the orders, which are fewer, and
    the lines lie by order afterwards. Columns of a sales line are worked out of these, not shuffled."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if vendors:
        lines = lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    orders = table(spark, sf_dir, "orders")
    if stores:
        customers = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _sales_columns(stores: bool = True, vendors: bool = True) -> list[Column]:
    nothing = F.lit(None).cast("string")
    order_date = F.to_date("o_orderdate").cast("string")
    columns = {
        "kafka_topic": F.lit("liquor_sales"),
        "process_date": order_date,
        "hour_id": _padded(F.col("l_orderkey") % 24, 2),
        "invoice_line_no": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "date": order_date,
        "store": _text("o_custkey"),
        "name": F.col("c_name") if stores else nothing,
        "address": F.concat(F.col("c_mktsegment"), F.lit(", row 1")) if stores else nothing,
        "city": F.col("n_name") if stores else nothing,
        "zipcode": _padded(F.col("o_custkey") % 100000, 5),
        "store_location": nothing,
        "county_number": _text("c_nationkey") if stores else nothing,
        "county": F.col("n_name") if stores else nothing,
        "category": F.col("p_brand"),
        "category_name": F.col("p_type"),
        "vendor_no": _text("l_suppkey"),
        "vendor_name": F.col("s_name") if vendors else nothing,
        "itemno": _text("l_partkey"),
        "im_desc": F.col("p_name"),
        "pack": F.col("p_size"),
        "bottle_volume_ml": F.lit(750.0),
        "state_bottle_cost": F.col("p_retailprice"),
        "state_bottle_retail": F.col("p_retailprice") * 1.5,
        "sale_bottles": F.col("l_quantity").cast("int"),
        "sale_dollars": F.col("l_extendedprice"),
        "sale_liters": F.col("l_quantity") * 0.75,
        "sale_gallons": F.col("l_quantity") * 0.198,
        "partition": _landing_day(),
    }
    return [columns[name].alias(name) for name in RAW_SALES.names]


def raw_sales(
    spark: SparkSession, sf_dir: str, stores: bool = True, vendors: bool = True
) -> DataFrame:
    """Sales lines by landing day. Store and vendor names only where asked for: each is a join."""
    return _sold(spark, sf_dir, stores, vendors).select(_sales_columns(stores, vendors))


def landed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the lines of a day together and in order of days, for a write by day: what travels and
    is sorted is what the lines were joined from."""
    sold = _sold(spark, sf_dir).withColumn("landed", _landing_day())
    sold = sold.hint("rebalance", "landed").sortWithinPartitions("landed")
    columns = [F.col("landed").alias("partition") if name == "partition" else column for name, column in zip(RAW_SALES.names, _sales_columns())]
    return sold.select(columns)


def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue, landed on one day. Some list dates are no dates, some ages are missing."""
    suppliers = table(spark, sf_dir, "supplier")
    vendor = F.col("p_partkey") % suppliers.agg(F.count(F.lit(1))).scalar()
    rows = table(spark, sf_dir, "part").withColumn("vendor", vendor)
    rows = rows.join(suppliers, F.col("vendor") == F.col("s_suppkey"), "left")
    month = F.col("p_partkey") % 13 + 1
    day = F.col("p_partkey") % 31 + 1
    listdate = F.concat_ws("-", F.lit("2020"), _padded(month, 2), _padded(day, 2))
    columns = {
        "itemno": _text("p_partkey"),
        "category_name": F.col("p_type"),
        "im_desc": F.col("p_name"),
        "vendor_no": _text("vendor"),
        "vendor_name": F.col("s_name"),
        "bottle_volume_ml": F.lit(750.0),
        "pack": F.col("p_size").cast("double"),
        "innerpack": F.lit(1.0),
        "age": F.when(F.col("p_size") > 10, F.col("p_size").cast("double")),
        "proof": F.when(F.col("p_type") != "ECONOMY", F.col("p_size") * 2.0),
        "listdate": F.when(F.col("p_size") == 1, "soon").otherwise(listdate),
        "upc": _padded(F.col("p_partkey"), 12),
        "scc": F.concat(F.lit("scc "), _text("p_partkey")),
        "state_bottle_cost": F.col("p_retailprice"),
        "state_case_cost": F.col("p_retailprice") * F.col("p_size"),
        "state_bottle_retail": F.col("p_retailprice") * 1.5,
        "date": F.lit("2024-01-01"),
        "partition": F.lit(LANDING_DAY),
    }
    return rows.select(*[columns[name].alias(name) for name in RAW_PRODUCT.names])


def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every store, landed on one day, with unknown codes and broken points among them."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    lon = F.concat(F.lit("-"), (key % 90 + 90).cast("string"), F.lit("."), (key % 1000).cast("string"))
    lat = F.concat((key % 50 + 20).cast("string"), F.lit("."), (key % 997).cast("string"))
    points = [
        F.concat(F.lit("POINT ("), lon, F.lit(" "), lat, F.lit(")")),
        F.concat(F.lit("POINT("), lon, F.lit("-"), lat, F.lit(")")),
        F.concat(F.lit("POINT ("), lon, F.lit("  "), lat, F.lit(")")),
        F.lit("POINT (-93 41)"),
        F.concat(F.lit("POINT ("), lon, F.lit(" "), lat),
        F.lit(""),
    ]
    point = F.coalesce(*[F.when(key % 7 == n, text) for n, text in enumerate(points)])
    status = F.coalesce(*[F.when(key % 4 == n, F.lit(text)) for n, text in enumerate("AIX")])
    codes = ["AZ", "CO", "IA", "IL", "OR", "NE", "ia"]
    state = F.coalesce(*[F.when(key % 8 == n, F.lit(code)) for n, code in enumerate(codes)])
    columns = {
        "store": _text("c_custkey"),
        "name": F.col("c_name"),
        "store_status": status,
        "address": F.concat(F.col("c_mktsegment"), F.lit(", row 1")),
        "city": F.col("n_name"),
        "state": state,
        "zipcode": _padded(key % 100000, 5),
        "store_address": point,
        "date": F.lit("2024-01-01"),
        "partition": F.lit(LANDING_DAY),
    }
    return rows.select(*[columns[name].alias(name) for name in RAW_STORE.names])


def sold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product snapshots: each landing day holds the products sold on it."""
    sold = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    days = sold.select(_text("l_partkey").alias("itemno"), _landing_day().alias("partition")).distinct()
    products = raw_product(spark, sf_dir).drop("partition")
    return products.join(days, "itemno").select(RAW_PRODUCT.names)


def open_stores(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Store snapshots: each landing day holds the stores that ordered on it."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    days = orders.select(_text("o_custkey").alias("store"), _landing_day().alias("partition")).distinct()
    stores = raw_store(spark, sf_dir).drop("partition")
    return stores.join(days, "store").select(RAW_STORE.names)


def solvent_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without stores in debt: their sales match no store."""
    solvent = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    orders = table(spark, sf_dir, "orders")
    orders = orders.join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return open_stores(spark, sf_dir, orders)


def _stage_days(raw: DataFrame, root: str) -> None:
    writer = raw.write.mode("overwrite").partitionBy("partition").option("header", False)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(root)


def _by_day(raw: DataFrame) -> DataFrame:
    return raw.hint("rebalance", "partition")


# Raw tables with a folder for every day that was ordered on, each staged when it is asked for.
DAYS = {
    "rd_liquor_sales": landed_sales,
    "rd_liquor_product": lambda spark, sf_dir: _by_day(sold_products(spark, sf_dir)),
    "rd_liquor_store": lambda spark, sf_dir: _by_day(open_stores(spark, sf_dir)),
}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message holds all lines of an order."""
    lines = _sold(spark, sf_dir).select("l_orderkey", *_sales_columns())
    lines = lines.select("l_orderkey", F.to_csv(F.struct(*SALES_LINE.names)).alias("line"))
    value = F.array_join(F.sort_array(F.collect_list("line")), "\n").cast("binary")
    return lines.groupBy("l_orderkey").agg(value.alias("value")).select("value")


def _stage(spark: SparkSession, sf_dir: str, what: str) -> str:
    root = work_folder(spark)
    lake = Lake(root)
    if what in DAYS:
        _stage_days(DAYS[what](spark, sf_dir), lake.raw(what))
    elif what == "one_day":
        # All rows lie in one folder, so there is nothing to bring together: a task writes its own file.
        sales = raw_sales(spark, sf_dir).withColumn("partition", F.lit(LANDING_DAY))
        _stage_days(sales, lake.raw("rd_liquor_sales"))
        _stage_days(raw_product(spark, sf_dir), lake.raw("rd_liquor_product"))
        _stage_days(raw_store(spark, sf_dir), lake.raw("rd_liquor_store"))
    elif what == "messages":
        # As many files as tasks wrote them. The join leaves the lines of an order side by side, so they are
        # collected as they come; a hash table of them would be filled, spilled and sorted anew.
        with session_conf(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"}):
            write_messages(messages(spark, sf_dir), root)
    else:
        raise ValueError(f"nothing to stage: {what}")
    return root


def write_messages(rows: DataFrame, root: str) -> None:
    """Messages as files. Their size is a size in bytes, like a segment of a topic, whatever size of task
    the session was set to."""
    with session_conf(rows.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": MESSAGE_FILE, **TIDY}):
        rows.write.option("compression", "zstd").option("parquet.block.size", MESSAGE_GROUP).parquet(root)


# Raw zones are inputs: staged once per application and state of the tables, then only read.
_STAGED: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, length and time of every table file: whoever changes a table gets it staged anew."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def staged(spark: SparkSession, sf_dir: str, what: str) -> str:
    key = (spark.sparkContext.applicationId, _state(spark, sf_dir), what)
    if key not in _STAGED:
        with session_conf(spark, TIDY):
            _STAGED[key] = _stage(spark, sf_dir, what)
    return _STAGED[key]


def day_range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    day = _landing_day()
    return tuple(table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first())
