"""The registered queries again, as DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.feed import LANDING_DAY

RAW_SALES = """
raw_sales AS (
  SELECT 'liquor_sales' AS kafka_topic,
         strftime(o_orderdate, '%Y-%m-%d') AS process_date,
         cast(o_orderdate AS date) AS order_date,
         lpad(cast(l_orderkey % 24 AS varchar), 2, '0') AS hour_id,
         l_orderkey || '-' || l_linenumber AS invoice_line_no,
         cast(o_custkey AS varchar) AS store, c_name AS name, c_acctbal,
         c_mktsegment || ', row 1' AS address, n_name AS city,
         p_brand AS category, p_type AS category_name,
         s_name AS vendor_name, cast(l_partkey AS varchar) AS itemno, p_name AS im_desc,
         p_size AS pack, p_retailprice AS state_bottle_cost,
         cast(l_quantity AS integer) AS sale_bottles, l_extendedprice AS sale_dollars,
         l_quantity * 0.75::double AS sale_liters, l_quantity * 0.198::double AS sale_gallons,
         strftime(o_orderdate, '%Y%m%d') AS "partition"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

FACT = f"""{RAW_SALES},
fact AS (
  SELECT invoice_line_no, order_date AS date_key, store AS store_id, itemno AS product_id,
         sale_bottles, sale_dollars, state_bottle_cost * sale_bottles AS cost_dollars,
         sale_dollars - state_bottle_cost * sale_bottles AS gross_profit,
         sale_liters, sale_gallons, "partition"
  FROM raw_sales
)"""

PRODUCT = f"""
product AS (
  SELECT cast(p_partkey AS varchar) AS id, p_type AS category, p_name AS product_desc,
         cast(p_partkey % (SELECT count(*) FROM supplier) AS varchar) AS vendor_id,
         s_name AS vendor_name, 750.0::double AS bottle_volume_ml, cast(p_size AS double) AS pack,
         1.0::double AS innerpack,
         CASE WHEN p_size > 10 THEN cast(p_size AS double) END AS age,
         CASE WHEN p_type <> 'ECONOMY' THEN p_size * 2.0::double END AS proof,
         CASE WHEN p_type <> 'ECONOMY' THEN p_size * 2.0::double END / 200 AS "ABV",
         CASE WHEN p_size <> 1 THEN try_cast('2020-' || lpad(cast(p_partkey % 13 + 1 AS varchar), 2, '0')
           || '-' || lpad(cast(p_partkey % 31 + 1 AS varchar), 2, '0') AS date) END AS listdate,
         lpad(cast(p_partkey AS varchar), 12, '0') AS upc, 'scc ' || p_partkey AS scc,
         p_retailprice AS state_bottle_cost, p_retailprice * p_size AS state_case_cost,
         p_retailprice * 1.5::double AS state_bottle_retail,
         date '2024-01-01' AS update_date, '{LANDING_DAY}' AS "partition"
  FROM part LEFT JOIN supplier ON p_partkey % (SELECT count(*) FROM supplier) = s_suppkey
)"""

# Fixed value: the same pattern of a point as in tillflow/functions/geo.py.
POINT = r"POINT\s*\((-?\d+\.\d+)\s*(-?\d+\.\d+)\)"
STORE = f"""
raw_store AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name,
         '-' || (c_custkey % 90 + 90) || '.' || (c_custkey % 1000) AS lon,
         (c_custkey % 50 + 20) || '.' || (c_custkey % 997) AS lat
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
point AS (
  SELECT *, CASE c_custkey % 7
           WHEN 0 THEN 'POINT (' || lon || ' ' || lat || ')'
           WHEN 1 THEN 'POINT(' || lon || '-' || lat || ')'
           WHEN 2 THEN 'POINT (' || lon || '  ' || lat || ')'
           WHEN 3 THEN 'POINT (-93 41)'
           WHEN 4 THEN 'POINT (' || lon || ' ' || lat
           WHEN 5 THEN '' END AS store_address
  FROM raw_store
),
store AS (
  SELECT cast(c_custkey AS varchar) AS id, c_name AS name,
         CASE c_custkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' WHEN 2 THEN 'X' END AS status,
         c_mktsegment || ', row 1' AS address, n_name AS city,
         CASE c_custkey % 8 WHEN 0 THEN 'Arizona' WHEN 1 THEN 'Colorado' WHEN 2 THEN 'Iowa'
           WHEN 3 THEN 'Illinois' WHEN 4 THEN 'Oregon' WHEN 5 THEN 'NE' WHEN 6 THEN 'ia' END AS state,
         lpad(cast(c_custkey % 100000 AS varchar), 5, '0') AS zipcode,
         date '2024-01-01' AS update_date, '{LANDING_DAY}' AS "partition",
         try_cast(regexp_extract(store_address, '{POINT}', 2) AS double) AS latitude,
         try_cast(regexp_extract(store_address, '{POINT}', 1) AS double) AS longitude,
         c_acctbal
  FROM point
)"""

SOLD = """
sold AS (
  SELECT DISTINCT cast(l_partkey AS varchar) AS id, cast(o_orderdate AS date) AS sold_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""
ORDERED = """
ordered AS (
  SELECT DISTINCT cast(o_custkey AS varchar) AS id, cast(o_orderdate AS date) AS order_date FROM orders
)"""


def _money(*sums: tuple[str, str]) -> str:
    return ",\n".join(f"cast(round({e}, 2) AS decimal(18,2)) AS {name}" for e, name in sums)


MEASURES = "cast(sum(sale_bottles) AS bigint) AS sale_bottles,\n" + _money(
    ("sum(state_bottle_cost * sale_bottles)", "tot_cost_dollars"),
    ("sum(sale_dollars)", "tot_sale_dollars"),
    ("sum(sale_dollars) - sum(state_bottle_cost * sale_bottles)", "tot_profit_dollars"),
    ("sum(sale_liters)", "sale_liters"),
    ("sum(sale_gallons)", "sale_gallons"),
)
STAR_SUMS = (
    "cast(count(*) AS bigint) AS sales_lines, cast(sum(sale_bottles) AS bigint) AS sale_bottles,\n"
    + _money(*[
        (f"sum({name})", name)
        for name in ("sale_dollars", "cost_dollars", "gross_profit", "sale_liters", "sale_gallons")
    ])
)


def _unmatched(column: str, name: str) -> str:
    return f"cast(count(*) FILTER (WHERE {column} IS NULL) AS bigint) AS {name}"


def _totals(*keys: tuple[str, str]) -> str:
    columns = ", ".join(f"{source} AS {name}" for source, name in keys)
    return f"""WITH {RAW_SALES}
SELECT kafka_topic, order_date AS prd_id, hour_id, {columns}, {MEASURES}
FROM raw_sales GROUP BY ALL"""


STORE_TOTALS = _totals(("name", "store_name"), ("city", "store_city"))
VENDOR_TOTALS = _totals(("vendor_name", "vendor_name"))
PRODUCT_TOTALS = _totals(("category_name", "category_name"), ("im_desc", "im_desc"))


def _one_grain(table: str, keys: list[str]) -> str:
    names = ["store_name", "store_city", "vendor_name", "category_name", "im_desc"]
    sources = {"store_name": "name", "store_city": "city"}
    columns = ", ".join(
        f"{sources.get(n, n)} AS {n}" if n in keys else f"cast(NULL AS varchar) AS {n}" for n in names
    )
    grouped = ", ".join(sources.get(n, n) for n in keys)
    return f"""SELECT '{table}' AS table_name, kafka_topic, order_date AS prd_id, hour_id, {columns},
{MEASURES} FROM raw_sales GROUP BY kafka_topic, order_date, hour_id, {grouped}"""


ALL_TOTALS = f"WITH {RAW_SALES}\n" + "\nUNION ALL\n".join([
    _one_grain("f001_store_tot_sales", ["store_name", "store_city"]),
    _one_grain("f002_vendor_tot_sales", ["vendor_name"]),
    _one_grain("f003_product_tot_sales", ["category_name", "im_desc"]),
])

HOLIDAYS = {
    "calendar": """
      (month(d) = 1 AND dayname(d) = 'Monday' AND day(d) BETWEEN 15 AND 21)
      OR (month(d) = 2 AND dayname(d) = 'Monday' AND day(d) BETWEEN 15 AND 21)
      OR (month(d) = 11 AND dayname(d) = 'Thursday' AND day(d) BETWEEN 22 AND 28)""",
    "iso_week": """
      (month(d) = 1 AND dayname(d) = 'Monday' AND weekofyear(d) = 3)
      OR (month(d) = 2 AND dayname(d) = 'Monday' AND weekofyear(d) = 3)
      OR (month(d) = 11 AND dayname(d) = 'Thursday' AND weekofyear(d) = 4)""",
}


def _days(first: str, last: str) -> str:
    return f"""days AS (
  SELECT cast(unnest(generate_series({first}, {last}, interval 1 day)) AS date) AS d
)"""


def _is_holiday(rule: str) -> str:
    return f"""CASE WHEN strftime(d, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25')
      OR (month(d) = 5 AND dayname(d) = 'Monday' AND day(d) > 24)
      OR (month(d) = 9 AND dayname(d) = 'Monday' AND day(d) <= 7)
      OR {HOLIDAYS[rule]} THEN 'yes' ELSE 'no' END"""


ORDER_DAYS = _days("(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)")

def _calendar(rule: str) -> str:
    return f"""WITH {ORDER_DAYS},
per_day AS (SELECT cast(o_orderdate AS date) AS o, count(*) AS n FROM orders GROUP BY 1)
{_date_rows(rule)}"""


def _date_rows(rule: str, more: str = "") -> str:
    return f"""SELECT {more} d AS full_date, strftime(d, '%Y-%m-%d') AS date_key, dayname(d) AS day_of_week,
       strftime(d, '%d') AS day_of_month, strftime(d, '%m') AS "month", monthname(d) AS month_name,
       cast(quarter(d) AS integer) AS "quarter", strftime(d, '%Y') AS "year",
       strftime(d, '%Y%m') AS year_month,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS is_weekend,
       {_is_holiday(rule)} AS is_holiday, cast(weekofyear(d) AS integer) AS week_of_year,
       cast(coalesce(n, 0) AS bigint) AS orders
FROM days LEFT JOIN per_day ON d = o"""


FACT_ROWS = f"WITH {FACT} SELECT * FROM fact"
PRODUCT_ROWS = f"WITH {PRODUCT} SELECT * FROM product"
STORE_ROWS = f"WITH {STORE} SELECT * EXCLUDE (c_acctbal) FROM store"

MESSAGE_COLUMNS = "process_date, hour_id, invoice_line_no"

ORACLE: dict[str, str] = {
    "fact_sales": FACT_ROWS,
    "fact_sales_csv": FACT_ROWS,
    "backfill_fact": FACT_ROWS,
    "fact_sales_day": f"""WITH {FACT} SELECT * REPLACE ('{LANDING_DAY}' AS "partition") FROM fact""",
    "fact_sales_lenient": f"""WITH {FACT}
SELECT * REPLACE (CASE WHEN cast(split_part(invoice_line_no, '-', 1) AS bigint) % 24 % 4 <> 2 THEN date_key END AS date_key)
FROM fact""",
    "fact_profit_by_day": f"""WITH {FACT}
SELECT "partition", count(*) AS sales_lines, {_money(("sum(gross_profit)", "gross_profit"))}
FROM fact GROUP BY 1""",
    "dim_product": PRODUCT_ROWS,
    "dim_product_csv": PRODUCT_ROWS,
    "dim_store": STORE_ROWS,
    "store_state_lookup": STORE_ROWS,
    "dim_store_csv": STORE_ROWS,
    "backfill_dim_product": f"""WITH {PRODUCT}, {SOLD}
SELECT product.* REPLACE (sold_date AS update_date, strftime(sold_date, '%Y%m%d') AS "partition")
FROM product JOIN sold USING (id)""",
    "backfill_dim_store": f"""WITH {STORE}, {ORDERED}
SELECT store.* EXCLUDE (c_acctbal)
       REPLACE (order_date AS update_date, strftime(order_date, '%Y%m%d') AS "partition")
FROM store JOIN ordered USING (id)""",
    "backfill_report": f"""WITH {ORDER_DAYS},
open AS (SELECT cast(o_orderdate AS date) AS o, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1)
SELECT strftime(d, '%Y%m%d') AS "partition",
       CASE WHEN n IS NULL THEN 'no_data' ELSE 'ok' END AS status,
       cast(coalesce(n, 0) AS bigint) AS "rows"
FROM days LEFT JOIN open ON d = o""",
    "backfill_changed_days": f"""WITH {ORDER_DAYS},
open AS (SELECT cast(o_orderdate AS date) AS o, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1)
SELECT strftime(d, '%Y%m%d') AS "partition",
       CASE WHEN n IS NULL THEN 'no_data' WHEN d = (SELECT max(o) FROM open) THEN 'ok' ELSE 'unchanged' END AS status,
       cast(CASE WHEN d = (SELECT max(o) FROM open) THEN n ELSE 0 END AS bigint) AS "rows"
FROM days LEFT JOIN open ON d = o""",
    "empty_day_status": f"""WITH {ORDER_DAYS},
open AS (
  SELECT cast(o_orderdate AS date) AS o, count(DISTINCT o_custkey) FILTER (o_custkey % 4 = 0) AS n FROM orders GROUP BY 1
)
SELECT strftime(d, '%Y%m%d') AS "partition",
       CASE WHEN n IS NULL THEN 'no_data' WHEN n = 0 THEN 'emptied' ELSE 'ok' END AS status,
       cast(coalesce(n, 0) AS bigint) AS "rows"
FROM days LEFT JOIN open ON d = o""",
    "day_versions": f"""WITH {FACT},
versions AS (
  SELECT 1 AS version, * FROM fact
  UNION ALL SELECT 2, * FROM fact
  WHERE sale_bottles > 30 OR "partition"[1:4] < (SELECT max("partition")[1:4] FROM fact)
)
SELECT version, "partition", count(*) AS sales_lines, cast(sum(sale_bottles) AS bigint) AS sale_bottles
FROM versions GROUP BY ALL""",
    "daily_run_log": f"""WITH {RAW_SALES}, {PRODUCT}, {STORE}
SELECT '{LANDING_DAY}' AS run_date, step, cast(1 AS integer) AS try_number, 'succeed' AS status,
       cast(n AS bigint) AS "rows"
FROM (
  SELECT 'product_daily' AS step, count(*) AS n FROM product
  UNION ALL SELECT 'store_daily', count(*) FROM store
  UNION ALL SELECT 'sales_daily', count(*) FROM raw_sales
)""",
    "dim_date_calendar": _calendar("calendar"),
    "dim_date_iso_week": _calendar("iso_week"),
    "dim_date_table": f"""WITH {_days("date '2020-01-01'", "date '2030-12-31'")},
per_day AS (SELECT cast(o_orderdate + INTERVAL 25 YEAR AS date) AS o, count(*) AS n FROM orders GROUP BY 1)
""" + "\nUNION ALL\n".join(_date_rows(rule, f"""'{rule}' AS "rule",""") for rule in HOLIDAYS),
    "f001_store_totals": STORE_TOTALS,
    "f002_vendor_totals": VENDOR_TOTALS,
    "f003_product_totals": PRODUCT_TOTALS,
    "all_totals_one_pass": ALL_TOTALS,
    "f001_stream": STORE_TOTALS,
    "f002_stream": VENDOR_TOTALS,
    "f003_stream": PRODUCT_TOTALS,
    "f001_stream_state_update": STORE_TOTALS,
    "f002_stream_state_complete": VENDOR_TOTALS,
    "stream_current_totals": STORE_TOTALS,
    "stream_levelled_totals": STORE_TOTALS,
    "f001_state_table": STORE_TOTALS,
    "f001_stream_watermark": STORE_TOTALS,
    "stream_restart_totals": PRODUCT_TOTALS,
    "totals_table_sql": VENDOR_TOTALS,
    "stream_message_parse": f"""WITH {RAW_SALES}
SELECT {MESSAGE_COLUMNS}, address, pack, sale_bottles, sale_gallons
FROM raw_sales WHERE sale_bottles % 5 IN (0, 1)
UNION ALL
SELECT {MESSAGE_COLUMNS}, address, pack, sale_bottles, sale_gallons
FROM raw_sales WHERE sale_bottles % 5 = 0
UNION ALL
SELECT {MESSAGE_COLUMNS}, NULL, NULL, NULL, NULL FROM raw_sales WHERE sale_bottles % 5 = 2
UNION ALL
SELECT {MESSAGE_COLUMNS}, address, pack, NULL, sale_gallons FROM raw_sales WHERE sale_bottles % 5 = 3""",
    "raw_landing": f"""WITH {RAW_SALES}
SELECT "partition", invoice_line_no, process_date AS "date", store, itemno, address, sale_bottles,
       sale_dollars
FROM raw_sales WHERE category NOT IN ('Brand#1', 'Brand#2')""",
    "raw_landing_compacted": f"""WITH {RAW_SALES}
SELECT "partition", invoice_line_no, process_date AS "date", store, itemno, address, sale_bottles,
       sale_dollars
FROM raw_sales WHERE category NOT IN ('Brand#1', 'Brand#2')
UNION ALL
SELECT "partition", invoice_line_no, process_date, store, itemno, address, sale_bottles, sale_dollars
FROM raw_sales WHERE sale_bottles = 1""",
    "raw_landing_rejects": f"""WITH {RAW_SALES}
SELECT invoice_line_no FROM raw_sales WHERE category IN ('Brand#1', 'Brand#2')""",
    "star_month_category": f"""WITH {FACT}, {PRODUCT}
SELECT strftime(date_key, '%Y%m') AS year_month, category AS product_category, {STAR_SUMS},
       cast(0 AS bigint) AS unmatched_dates, {_unmatched("id", "unmatched_products")}
FROM fact LEFT JOIN product ON product_id = id GROUP BY 1, 2""",
    "star_store_state": f"""WITH {FACT}, {STORE}
SELECT state AS store_state, status AS store_status, {STAR_SUMS},
       {_unmatched("id", "unmatched_stores")}
FROM fact LEFT JOIN (SELECT * FROM store WHERE c_acctbal >= 0) ON store_id = id GROUP BY 1, 2""",
    "star_same_day_product": f"""WITH {FACT}, {PRODUCT}
SELECT vendor_name AS product_vendor_name, {STAR_SUMS}, cast(0 AS bigint) AS unmatched_products
FROM fact JOIN product ON product_id = id GROUP BY 1""",
    "star_quarter_sales": f"""WITH {FACT}
SELECT strftime(date_key, '%Y%m') AS year_month, {STAR_SUMS}, cast(0 AS bigint) AS unmatched_dates
FROM fact WHERE quarter(date_key) = 2 GROUP BY 1""",
    "star_in_force_product": f"""WITH {FACT}, {PRODUCT}, {SOLD},
snapshots AS (
  SELECT product.id AS product_id, vendor_name AS product_vendor_name, strftime(sold_date, '%Y%m%d') AS product_as_of
  FROM product JOIN sold USING (id) WHERE day(sold_date) <= 10
)
SELECT product_vendor_name, product_as_of, {STAR_SUMS}, {_unmatched("product_as_of", "unmatched_products")}
FROM fact ASOF LEFT JOIN snapshots ON fact.product_id = snapshots.product_id AND "partition" >= product_as_of
GROUP BY 1, 2""",
    "star_bucketed_product": f"""WITH {FACT}, {PRODUCT}
SELECT category AS product_category, vendor_name AS product_vendor_name, {STAR_SUMS},
       {_unmatched("id", "unmatched_products")}
FROM fact LEFT JOIN product ON product_id = id GROUP BY 1, 2""",
    "star_weekend_holiday": f"""WITH {FACT}, {PRODUCT}, {STORE}, day_flags AS (
  SELECT DISTINCT date_key AS d FROM fact
)
SELECT CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS is_weekend,
       {_is_holiday("calendar")} AS is_holiday, product.vendor_name AS product_vendor_name,
       store.state AS store_state, {STAR_SUMS}, cast(0 AS bigint) AS unmatched_dates,
       {_unmatched("product.id", "unmatched_products")},
       {_unmatched("store.id", "unmatched_stores")}
FROM fact JOIN day_flags ON date_key = d
LEFT JOIN product ON product_id = product.id LEFT JOIN store ON store_id = store.id
GROUP BY 1, 2, 3, 4""",
    "gold_table_sql": f"""WITH {FACT}
SELECT substr("partition", 1, 4) AS sale_year, product_id, count(*) AS sales_lines,
       {_money(("sum(sale_dollars)", "sale_dollars"), ("sum(gross_profit)", "gross_profit"))}
FROM fact GROUP BY 1, 2""",
    "log_quantiles": """SELECT event_type AS table_name, count(*) AS batches, rank::DOUBLE AS rank, true AS "close"
FROM events, (SELECT unnest([0.5, 0.95, 0.99]) AS rank) GROUP BY 1, 3""",
    "log_health_report": """SELECT 'app ' || user_id AS app_name, props AS table_name,
       count(*) AS batches, cast(sum(event_id) AS bigint) AS records,
       cast(round(avg(value), 6) AS decimal(18,6)) AS mean_seconds,
       cast(round(max(value), 2) AS decimal(18,2)) AS max_seconds,
       cast(count(*) FILTER (WHERE event_type = 'error') AS bigint) AS errors,
       avg(value) > 30.0007 OR max(value) > 200.0
         OR count(*) FILTER (WHERE event_type = 'error') > 1 AS alert
FROM events GROUP BY 1, 2""",
}

LOG_RECORDS = f"""WITH {RAW_SALES}
SELECT 'LIQUOR_SALES_BI_STREAMING' AS app_name, table_name, 'succeed' AS status,
       cast(count(DISTINCT split_part(invoice_line_no, '-', 1)) AS bigint) AS records
FROM raw_sales, (VALUES ('f001_store_tot_sales'), ('f002_vendor_tot_sales'),
                        ('f003_product_tot_sales')) AS t(table_name)
GROUP BY 1, 2, 3"""
ORACLE["stream_log"] = LOG_RECORDS
ORACLE["stream_progress_log"] = LOG_RECORDS
