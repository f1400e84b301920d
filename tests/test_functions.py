import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import sales_line
from tillflow.functions.codes import state_name, store_status
from tillflow.functions.dates import day_key_to_date, text_to_date
from tillflow.functions.geo import latitude, longitude
from tillflow.functions.lines import message_lines
from tillflow.lake import Lake, days_between, previous_day
from tillflow.session import CHECKPOINT_DIR, session_conf, work_folder
from tillflow.sources.messages import kafka_options, lines_of, parse_sales


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, t STRING")


def column(frame, expression):
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


DATES = [
    ("2024-12-01", date(2024, 12, 1), date(2024, 12, 1)),
    ("2024-1-2", None, date(2024, 1, 2)),
    ("2024-12-01 08:00:00", None, date(2024, 12, 1)),
    (" 2024-12-01", None, date(2024, 12, 1)),
    ("2024-02-30", None, None),
    ("2024-01-123", None, None),
    ("2024-1-2x", None, date(2024, 1, 2)),
    ("2024-12-011", None, None),
    ("2024-12", None, None),
    ("", None, None),
    ("x", None, None),
    (None, None, None),
]


def test_text_to_date(spark):
    frame = texts(spark, [text for text, _, _ in DATES])
    assert column(frame, text_to_date("t")) == [strict for _, strict, _ in DATES]
    assert column(frame, text_to_date("t", lenient=True)) == [lenient for _, _, lenient in DATES]


def test_day_key_to_date(spark):
    frame = texts(spark, ["20241201", "20240230", "junk", None])
    assert column(frame, day_key_to_date("t")) == [date(2024, 12, 1), None, None, None]


def test_codes(spark):
    frame = texts(spark, ["IA", "NE", "ia", None, "AZ", "CO", "IL", "OR"])
    names = ["Iowa", "NE", "ia", None, "Arizona", "Colorado", "Illinois", "Oregon"]
    assert column(frame, state_name(F.col("t"))) == names
    frame = texts(spark, ["A", "I", "X", None, "a"])
    assert column(frame, store_status(F.col("t"))) == ["active", "inactive", "X", None, "a"]


POINTS = [
    ("POINT (-93.6 41.6)", 41.6, -93.6),
    ("POINT(-93.5-41.25)", -41.25, -93.5),
    ("POINT   (93.5   41.25)", 41.25, 93.5),
    ("in POINT (1.5 2.5) there", 2.5, 1.5),
    ("POINT (-93 41)", None, None),
    ("POINT (-93.55 41.66", None, None),
    ("", None, None),
    (None, None, None),
]


def test_points(spark):
    frame = texts(spark, [text for text, _, _ in POINTS])
    assert column(frame, latitude(F.col("t"))) == [lat for _, lat, _ in POINTS]
    assert column(frame, longitude(F.col("t"))) == [lon for _, _, lon in POINTS]


def test_message_lines(spark):
    frame = texts(spark, ["a\nb", "a\n", "\n\na\r\nb\r\n  \n", "a\r", "", None])
    expected = [["a", "b"], ["a"], ["a", "b"], ["a"], [], None]
    assert column(frame, message_lines(F.col("t"))) == expected
    kept = column(frame, message_lines(F.col("t"), keep_blank=True))
    assert kept == [["a", "b"], ["a", ""], ["", "", "a\r", "b\r", "  ", ""], ["a\r"], [""], None]


ODD_MESSAGES = [
    "a\r\r\nb\r\r", "\ra\n\r", "\r\n\r\r\n \r\n", "a\rb\r\nc", " \r", "\r \n", "é\r\n\tü \r", "\n", "\r", "x\n\n y\r\n\r",
]


def test_lines_are_cut_without_a_regular_expression(spark):
    """As `\\r?\\n`, or a CR at the very end, cuts them."""
    frame = texts(spark, ODD_MESSAGES)
    expected = [[line for line in re.split(r"\r?\n|\r\Z", text) if line.strip(" ")] for text in ODD_MESSAGES]
    assert column(frame, message_lines(F.col("t"))) == expected
    lines = lines_of(frame.select(F.col("t").cast("binary").alias("value")))
    assert sorted(row.line for row in lines.collect()) == sorted(line for part in expected for line in part)
    assert "r?" not in lines._jdf.queryExecution().executedPlan().toString()


def parsed(spark, *messages, **options):
    frame = spark.createDataFrame(
        [(m.encode() if m is not None else None,) for m in messages], "value BINARY"
    )
    return parse_sales(frame, **options).collect()


def test_quoted_comma_and_crlf(spark):
    line = sales_line(name='"Shop, North"')
    rows = parsed(spark, line + "\r\n" + line)
    assert [row["name"] for row in rows] == ["Shop, North"] * 2
    assert [row["sale_gallons"] for row in rows] == [0.5] * 2


@pytest.mark.parametrize("bad", ["oops", "12.0", " 5 "])
def test_bad_number_leaves_the_row(spark, bad):
    (row,) = parsed(spark, sales_line(sale_bottles=bad))
    assert row["sale_bottles"] is None
    assert (row["hour_id"], row["sale_dollars"]) == ("08", 12.0)


def test_short_and_long_lines(spark):
    line = sales_line()
    short, long = parsed(spark, ",".join(line.split(",")[:20]), line + ",a,b,c")
    assert short["pack"] == 6 and short["sale_dollars"] is None
    assert long["sale_gallons"] == 0.5 and len(long) == 27


def test_blank_lines_and_null_messages(spark):
    assert len(parsed(spark, sales_line() + "\n", None)) == 1
    rows = parsed(spark, sales_line() + "\n", None, keep_blank=True)
    assert len(rows) == 2
    assert any(all(value is None for value in row) for row in rows)


def test_bottle_volume_takes_decimals(spark):
    (row,) = parsed(spark, sales_line(bottle_volume_ml="750.0"))
    assert row["bottle_volume_ml"] == 750.0


def test_work_folder(spark):
    shared = spark.conf.get(CHECKPOINT_DIR)
    first, second = work_folder(spark), work_folder(spark)
    assert first != second
    assert first.startswith(f"{shared}/") and second.startswith(f"{shared}/")


def test_session_conf(spark):
    name = "spark.sql.shuffle.partitions"
    with session_conf(spark, {name: 7, "spark.sql.tillflow.test": "a", "spark.sql.other": None}):
        assert (spark.conf.get(name), spark.conf.get("spark.sql.tillflow.test")) == ("7", "a")
    assert (spark.conf.get(name), spark.conf.get("spark.sql.tillflow.test", None)) == ("4", None)


def test_previous_day():
    assert previous_day(datetime(2025, 1, 1, 2, 0)) == "20241231"
    late = datetime(2024, 12, 31, 20, 0, tzinfo=timezone.utc)
    assert previous_day(late) == "20241230"
    assert previous_day(late, "Asia/Ho_Chi_Minh") == "20241231"


def test_days_between():
    assert days_between("20241230", "20250102") == ["20241230", "20241231", "20250101", "20250102"]
    assert days_between("20250102", "20250101") == []


def test_paths():
    lake = Lake("hdfs://lake")
    place = "sales/bi_core/country=usa/state=iowa"
    assert lake.raw("t") == f"hdfs://lake/raw_zone/{place}/t"
    assert lake.gold("t") == f"hdfs://lake/gold_zone/{place}/t"
    assert lake.streaming("t").startswith("hdfs://lake/gold_zone/sales/bi_core/streaming/")
    assert lake.checkpoint("t") == "hdfs://lake/work_zone/tmp/bi_streaming/spark/checkpoint/t"


def test_kafka_options():
    options = kafka_options("a:1,b:1", "liquor_sales", **{"kafka.security.protocol": "SSL"})
    assert options["kafka.bootstrap.servers"] == "a:1,b:1"
    assert options["subscribe"] == "liquor_sales"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "100"
    assert options["kafka.security.protocol"] == "SSL"
    assert "maxOffsetsPerTrigger" not in kafka_options("a:1", "t", max_offsets_per_trigger=None)
