import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.lake import Lake  # noqa: E402
from tillflow.session import CHECKPOINT_DIR, spark_session  # noqa: E402

SALES_DEFAULTS = {
    "kafka_topic": "liquor_sales",
    "process_date": "2024-12-01",
    "hour_id": "08",
    "store": "s1",
    "name": "Corner Shop",
    "city": "Ames",
    "category_name": "Vodka",
    "vendor_name": "North",
    "itemno": "p1",
    "im_desc": "Clear",
    "pack": 6,
    "bottle_volume_ml": 750.0,
    "state_bottle_cost": 4.0,
    "state_bottle_retail": 6.0,
    "sale_bottles": 2,
    "sale_dollars": 12.0,
    "sale_liters": 1.5,
    "sale_gallons": 0.5,
    "partition": "20241201",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def nothing_stays_cached(request):
    """What a test cached is not met by the next."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def make(spark):
    """Rows of a schema from dictionaries; fields left out are NULL or the given defaults."""

    def build(schema, rows, defaults=None):
        full = [{**(defaults or {}), **row} for row in rows]
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in full], schema)

    return build


@pytest.fixture
def put_csv(lake):
    """Write lines as one raw file of a day."""

    def put(table, day, lines, name="part-0.csv"):
        folder = os.path.join(lake.raw(table), f"partition={day}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as file:
            file.write("".join(f"{line}\n" for line in lines))

    return put


def sales_line(**fields):
    """One CSV line of the 27 stream fields."""
    from tillflow.schemas import SALES_LINE

    values = {**SALES_DEFAULTS, **fields}
    return ",".join("" if values.get(n) is None else str(values[n]) for n in SALES_LINE.names)


def rows_of(frame, *columns):
    """Rows as sorted tuples; None sorts first."""
    rows = [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])
