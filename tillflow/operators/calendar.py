from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import DIM_DATE

# Default range of the date table and the holidays.
START, END = "2020-01-01", "2030-12-31"
FIXED_HOLIDAYS = ["01-01", "07-04", "11-11", "12-25"]
# Month, weekday, first and last day of month.
MEMORIAL_DAY = (5, "Monday", 25, 31)
LABOR_DAY = (9, "Monday", 1, 7)
NTH_WEEKDAY_HOLIDAYS = [
    (1, "Monday", 15, 21),
    (2, "Monday", 15, 21),
    MEMORIAL_DAY,
    LABOR_DAY,
    (11, "Thursday", 22, 28),
]
# Month, weekday, ISO week of the year.
ISO_WEEK_HOLIDAYS = [(1, "Monday", 3), (2, "Monday", 3), (11, "Thursday", 4)]


def is_holiday(day: Column, rule: str = "calendar") -> Column:
    """True on a holiday.

    `calendar` counts weekdays of the month. `iso_week` takes three of the holidays by the ISO week
    of the year: that misses Presidents' Day and Thanksgiving, and is a week early for Martin
    Luther King Day in some years; it gives the flags the existing date table holds.
    """
    weekday = F.date_format(day, "EEEE")

    def by_days(month: int, name: str, first: int, last: int) -> Column:
        return (F.month(day) == month) & (weekday == name) & F.day(day).between(first, last)

    def by_week(month: int, name: str, week: int) -> Column:
        return (F.month(day) == month) & (weekday == name) & (F.weekofyear(day) == week)

    if rule == "calendar":
        floating = [by_days(*holiday) for holiday in NTH_WEEKDAY_HOLIDAYS]
    elif rule == "iso_week":
        floating = [by_week(*holiday) for holiday in ISO_WEEK_HOLIDAYS]
        floating += [by_days(*MEMORIAL_DAY), by_days(*LABOR_DAY)]
    else:
        raise ValueError(f"unknown holiday rule: {rule}")
    return reduce(or_, floating, F.date_format(day, "MM-dd").isin(FIXED_HOLIDAYS))


def with_calendar(days: DataFrame, rule: str = "calendar") -> DataFrame:
    """Adds the date table's columns to any frame with a `full_date`; other columns stay behind."""
    day = F.col("full_date")
    weekday = F.date_format(day, "EEEE")
    calendar = days.withColumns(
        {
            "date_key": F.date_format(day, "yyyy-MM-dd"),
            "day_of_week": weekday,
            "day_of_month": F.date_format(day, "dd"),
            "month": F.date_format(day, "MM"),
            "month_name": F.date_format(day, "MMMM"),
            "quarter": F.quarter(day),
            "year": F.date_format(day, "yyyy"),
            "year_month": F.date_format(day, "yyyyMM"),
            "is_weekend": F.when(weekday.isin("Saturday", "Sunday"), "weekend").otherwise("weekday"),
            "is_holiday": F.when(is_holiday(day, rule), "yes").otherwise("no"),
            "week_of_year": F.weekofyear(day),
        }
    )
    others = [name for name in days.columns if name not in DIM_DATE.names]
    return calendar.select(*DIM_DATE.names, *others)


def build_dim_date(
    spark: SparkSession, start: str = START, end: str = END, rule: str = "calendar"
) -> DataFrame:
    """One row per day, both ends included. Spark knows the row count, so joins can broadcast it."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    first = F.lit(start).cast("date")
    full_date = F.date_add(first, F.col("id").cast("int")).alias("full_date")
    return with_calendar(spark.range(0, max(days, 0), 1, 1).select(full_date), rule)


def date_spine(dates: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date in a column, found within the same plan."""
    ends = dates.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    every_day = F.sequence("first", "last", F.expr("interval 1 day"))
    return ends.where(F.col("first").isNotNull()).select(F.explode(every_day).alias("full_date"))
