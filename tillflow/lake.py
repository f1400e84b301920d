"""Where each table lives, and which day a run is for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql.types import StructType

from tillflow import schemas

# Table names of the raw and gold zones.
RAW_TABLES: dict[str, StructType] = {
    "rd_liquor_sales": schemas.RAW_SALES,
    "rd_liquor_product": schemas.RAW_PRODUCT,
    "rd_liquor_store": schemas.RAW_STORE,
}
GOLD_TABLES: dict[str, StructType] = {
    "fact_liquor_sales": schemas.FACT_SALES,
    "dim_liquor_product": schemas.DIM_PRODUCT,
    "dim_liquor_store": schemas.DIM_STORE,
    "dim_iowa_date": schemas.DIM_DATE,
}


@dataclass(frozen=True)
class Lake:
    """Path grammar: {root}/{zone}/sales/bi_core/country=…/state=…/{table}/partition={yyyyMMdd}."""

    root: str
    country: str = "usa"
    state: str = "iowa"

    def _place(self) -> str:
        return f"country={self.country}/state={self.state}"

    def raw(self, table: str) -> str:
        return f"{self.root}/raw_zone/sales/bi_core/{self._place()}/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold_zone/sales/bi_core/{self._place()}/{table}"

    def streaming(self, name: str) -> str:
        return f"{self.root}/gold_zone/sales/bi_core/streaming/{self._place()}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/work_zone/tmp/bi_streaming/spark/checkpoint/{name}"


def day_key(day: date) -> str:
    return day.strftime("%Y%m%d")


def parse_day(day: str) -> date:
    return datetime.strptime(day, "%Y%m%d").date()


def previous_day(now: datetime | None = None, tz: str = "UTC") -> str:
    """The day before `now` in the given zone; a naive `now` is taken as local to that zone."""
    zone = ZoneInfo(tz)
    now = datetime.now(zone) if now is None else now
    local = now.astimezone(zone) if now.tzinfo else now
    return day_key(local.date() - timedelta(days=1))


def days_between(start: str, end: str) -> list[str]:
    """Every day from start to end, both included."""
    first, last = parse_day(start), parse_day(end)
    return [day_key(first + timedelta(days=n)) for n in range((last - first).days + 1)]
