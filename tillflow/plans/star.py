"""Star queries over the fact and its dimensions.

Joins are plain equi joins: Spark broadcasts a side that is small in bytes, and splits the partitions
of a hot key where none is. So that a sale can meet one dimension row only, each dimension is cut to
one row per key and written first; with both sides of a join plain shuffles, the split applies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.session import work_folder

FACT_SUMS = [
    "sale_bottles",
    "sale_dollars",
    "cost_dollars",
    "gross_profit",
    "sale_liters",
    "sale_gallons",
]


@dataclass(frozen=True)
class Side:
    """One dimension, cut to its join keys and the attributes asked for."""

    rows: DataFrame
    on: list[str]
    unmatched: str

    def join_to(self, facts: DataFrame) -> DataFrame:
        """Left join; facts without a partner keep their lines and count as unmatched."""
        joined = facts.join(self.one_per_key().withColumn("found", F.lit(True)), self.on, "left")
        missing = F.when(F.col("found").isNull(), F.col("sales_lines")).otherwise(0)
        return joined.withColumn(self.unmatched, missing).drop("found")

    def one_per_key(self) -> DataFrame:
        """Of several rows of one key the least by its attributes, in their order."""
        attributes = [name for name in self.rows.columns if name not in self.on]
        if not attributes:
            return _written(self.rows.distinct())
        least = F.min(F.struct(*attributes)).alias("least")
        # The least of texts is found by sorting. Rows are dealt by key before, in shares that Spark does not
        # join again: keys and days compress so well that a share of few bytes holds a great many rows.
        shares = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = self.rows.repartition(shares, *self.on)
        return _written(dealt.groupBy(*self.on).agg(least).select(*self.on, "least.*"))


def _written(rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared work folder: its size is known before the join is planned."""
    folder = work_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def repeated_keys(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of a dimension that more than one row holds, with their number of rows."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def latest_day(dim: DataFrame) -> DataFrame:
    """The rows of the newest snapshot; the subquery's result prunes the other folders."""
    newest = dim.agg(F.max("partition")).scalar()
    return dim.where(F.col("partition") == newest)


def _date_side(dates: DataFrame, by: list[str]) -> Side:
    wanted = [name for name in by if name in dates.columns and name != "date_key"]
    return Side(dates.select(F.col("full_date").alias("date_key"), *wanted), ["date_key"], "unmatched_dates")


def _snapshot_side(dim: DataFrame, kind: str, by: list[str], snapshot: str) -> Side:
    key = f"{kind}_id"
    wanted = [name for name in by if name.startswith(f"{kind}_") and name != key]
    columns = [F.col(name.removeprefix(f"{kind}_")).alias(name) for name in wanted]
    if snapshot == "same_day":
        rows = dim.select(F.col("id").alias(key), "partition", *columns)
        return Side(rows, [key, "partition"], f"unmatched_{kind}s")
    rows = latest_day(dim).select(F.col("id").alias(key), *columns)
    return Side(rows, [key], f"unmatched_{kind}s")


def star_sales(
    fact: DataFrame,
    by: list[str],
    dates: DataFrame | None = None,
    products: DataFrame | None = None,
    stores: DataFrame | None = None,
    snapshot: str = "same_day",
    row_cap: int | None = None,
) -> DataFrame:
    """Sales sums by dimension attributes.

    `by` names fact and date columns as they are, product columns as `product_<name>` and store
    columns as `store_<name>`. snapshot "same_day" takes the dimension row of the fact's own day,
    "latest" the newest day of the dimension. Facts without a dimension row stay, under NULL, and
    are counted in `unmatched_dates`, `unmatched_products` and `unmatched_stores`. Where a dimension
    repeats a key, one row of it counts; `repeated_keys` lists them. row_cap keeps the rows with the
    largest sales.
    """
    if snapshot not in ("same_day", "latest"):
        raise ValueError(f"unknown snapshot rule: {snapshot}")
    sides = [_date_side(dates, by)] if dates is not None else []
    for kind, dim in (("product", products), ("store", stores)):
        if dim is not None:
            sides.append(_snapshot_side(dim, kind, by, snapshot))

    facts, sums = fact.withColumn("sales_lines", F.lit(1).cast("long")), ["sales_lines", *FACT_SUMS]
    for side in sides:
        facts, sums = side.join_to(facts), [*sums, side.unmatched]
    result = facts.groupBy(*by).agg(*[F.sum(name).alias(name) for name in sums])
    if row_cap is not None:
        result = result.orderBy(F.desc("sale_dollars"), *by).limit(row_cap)
    return result


def sales_of_dates(fact: DataFrame, dates: DataFrame, condition: str) -> DataFrame:
    """The facts that lie in the day folders of the dates a condition on the calendar picks.

    The join is on the folder column, so the days that the date table gives are known before the fact is
    listed, and the scan opens their folders only. A date table read from files is needed for that;
    with any other the result is the same, and every folder is read.
    """
    days = dates.where(condition).select(F.date_format("full_date", "yyyyMMdd").alias("partition"))
    return fact.join(days, "partition", "left_semi").select(fact.columns)


def validity(dim: DataFrame) -> DataFrame:
    """Snapshots with the days they are in force: from their own (`valid_from`) to the one before the
    next snapshot of the id (`valid_to`, NULL for the newest), both yyyyMMdd. Of several rows of an id
    and day the least by its attributes counts."""
    attributes = [name for name in dim.columns if name not in ("id", "partition")]
    one = dim.groupBy("id", "partition").agg(F.min(F.struct(*attributes)).alias("least"))
    following = F.lead("partition").over(Window.partitionBy("id").orderBy("partition"))
    before = F.date_format(F.date_sub(F.to_date(following, "yyyyMMdd"), 1), "yyyyMMdd")
    return one.select("id", F.col("partition").alias("valid_from"), before.alias("valid_to"), "least.*")


def in_force(fact: DataFrame, dim: DataFrame, kind: str, wanted: list[str]) -> DataFrame:
    """The fact with `wanted` columns of the snapshot in force on each sale's own day, as `<kind>_<name>`,
    and `<kind>_as_of`, the day of that snapshot; NULL before the first snapshot of an id.

    An id's snapshots and the days it was sold on go through one ordered window, each day once however
    many sales it has; the sales then meet their day's row by equality.
    """
    key, found = f"{kind}_id", F.struct(F.col("partition").alias("as_of"), *wanted)
    snapshots = dim.groupBy("id", "partition").agg(F.min(F.struct(*wanted)).alias("least")).select("id", "partition", "least.*")
    snapshots = snapshots.select("id", "partition", F.lit(0).alias("sold"), found.alias("snapshot"))
    sold = fact.select(F.col(key).alias("id"), "partition").distinct()
    sold = sold.select("id", "partition", F.lit(1).alias("sold"), F.lit(None).cast(snapshots.schema["snapshot"].dataType).alias("snapshot"))
    so_far = Window.partitionBy("id").orderBy("partition", "sold").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = F.last("snapshot", ignorenulls=True).over(so_far)
    resolved = snapshots.unionByName(sold).select("id", "partition", "sold", newest.alias("found")).where("sold = 1")
    named = [F.col(f"found.{name}").alias(f"{kind}_{name}") for name in ["as_of", *wanted]]
    days = _written(resolved.select(F.col("id").alias(key), "partition", *named))
    return fact.join(days, [key, "partition"], "left")


def star_in_force(fact: DataFrame, products: DataFrame, by: list[str]) -> DataFrame:
    """Sales sums by product attributes, each sale with the snapshot in force on its day."""
    wanted = [name.removeprefix("product_") for name in by if name != "product_as_of"]
    joined = in_force(fact, products, "product", wanted)
    missing = F.sum(F.col("product_as_of").isNull().cast("long")).alias("unmatched_products")
    sums = [F.sum(name).alias(name) for name in FACT_SUMS]
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("sales_lines"), *sums, missing)


def star_bucketed(fact: DataFrame, products: DataFrame, by: list[str]) -> DataFrame:
    """Sales sums by product attributes out of tables bucketed by product (`write_bucketed`): with as many
    buckets on both sides the join needs no exchange. The dimension holds one row per id."""
    wanted = [F.col(name.removeprefix("product_")).alias(name) for name in by]
    rows = products.select(F.col("id").alias("product_id"), F.lit(True).alias("found"), *wanted)
    # Merged bucket by bucket: a hash table of a large dimension would not fit, and needs no shuffle less.
    joined = fact.join(rows.hint("merge"), "product_id", "left")
    missing = F.sum(F.col("found").isNull().cast("long")).alias("unmatched_products")
    sums = [F.sum(name).alias(name) for name in FACT_SUMS]
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("sales_lines"), *sums, missing)
