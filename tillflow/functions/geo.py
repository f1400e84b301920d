from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: point text is longitude first; both numbers need a decimal part.
POINT = r"POINT\s*\((-?\d+\.\d+)\s*(-?\d+\.\d+)\)"


def longitude(point: Column) -> Column:
    return F.regexp_extract(point, POINT, 1).try_cast("double")


def latitude(point: Column) -> Column:
    return F.regexp_extract(point, POINT, 2).try_cast("double")
