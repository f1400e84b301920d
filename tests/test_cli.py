import pytest

from tests.conftest import rows_of
from tests.test_jobs import put_all
from tillflow.cli import parser, run, totals_store
from tillflow.plans.daily import SALES
from tillflow.sources.gold import read_gold
from tillflow.streaming.totals import TotalsStore


def call(spark, lake, *arguments):
    return run(spark, parser().parse_args(["--lake", lake.root, *arguments]))


def test_days_and_backfill(spark, lake, put_csv, capsys):
    put_all(put_csv, "20241201")
    put_all(put_csv, "20241202")
    assert call(spark, lake, "sales", "--date", "20241201") == 0
    assert "4 rows written to " in capsys.readouterr().out
    assert call(spark, lake, "daily", "--date", "20241202") == 0
    log = spark.read.parquet(lake.gold("run_logs"))
    assert rows_of(log, "step", "status") == [
        ("product_daily", "succeed"),
        ("sales_daily", "succeed"),
        ("store_daily", "succeed"),
    ]
    assert call(spark, lake, "backfill", "sales", "20241130", "20241202") == 0
    assert "20241130 no_data 0" in capsys.readouterr().out
    assert read_gold(spark, lake, SALES.gold).count() == 8
    assert call(spark, lake, "daily", "--date", "20241203", "--retries", "0") == 1


def test_dates(spark, lake, capsys):
    assert call(spark, lake, "dates", "--start", "2024-01-01", "--end", "2024-12-31") == 0
    assert "366 rows written to " in capsys.readouterr().out


def test_stream_needs_servers(lake):
    with pytest.raises(SystemExit):
        parser().parse_args(["--lake", lake.root, "totals"])
    args = parser().parse_args(["--lake", lake.root, "totals", "--servers", "a:9092"])
    assert (args.topic, args.max_offsets, args.every, args.mode) == (
        "liquor_sales",
        100,
        "1 minute",
        "delta",
    )
    assert totals_store(lake) == TotalsStore(lake.streaming("running_totals"))


def test_versioned_days_and_changed_days(spark, lake, put_csv, capsys):
    put_all(put_csv, "20241201")
    put_all(put_csv, "20241202")
    assert call(spark, lake, "--versioned", "sales", "--date", "20241201") == 0
    assert call(spark, lake, "backfill", "sales", "20241201", "20241202", "--changed") == 0
    assert "20241202 ok 4" in capsys.readouterr().out
    assert call(spark, lake, "backfill", "sales", "20241201", "20241202", "--changed") == 0
    assert "20241202 unchanged 0" in capsys.readouterr().out
    assert read_gold(spark, lake, SALES.gold).count() == 8
    assert call(spark, lake, "compact-landing", "20250101", "--drop") == 0
    assert "days packed: 0" in capsys.readouterr().out
    assert call(spark, lake, "fold", "--by-day", "--drop") == 0
    assert "days rewritten: 0" in capsys.readouterr().out
