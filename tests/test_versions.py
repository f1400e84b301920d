"""Day versions, and what is built on them: compaction of landed days, folds by day, changed-days backfill."""

import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of, sales_line
from tests.test_jobs import STORE_LINE, fingerprint, put_sales, statuses
from tests.test_streaming import BATCHES, Feed, drain
from tillflow import schemas
from tillflow.files import file_states, matching
from tillflow.operators.totals import totals
from tillflow.plans.backfill import backfill, backfill_versions
from tillflow.plans.daily import PRODUCT, SALES, STORE, EmptyInput, load_day
from tillflow.sinks.gold import replace_days
from tillflow.sources.gold import read_gold, read_gold_days, rows_per_day
from tillflow.sources.raw import day_sources, read_raw_day, read_raw_days
from tillflow.streaming import compaction
from tillflow.streaming.compaction import compact_landing, drop_compacted, pack
from tillflow.streaming.current import current_totals, days_up_to, fold, folded_days, levels_root
from tillflow.streaming.landing import TABLE, land_batch
from tillflow.streaming.levels import drop_levelled, fold_days
from tillflow.streaming.totals import TotalsStore
from tillflow.versions import Day, commit, is_versioned, read_manifest, read_versioned, replaced, vacuum

NUMBERS = schemas.StructType().add("n", schemas.LONG).add("partition", schemas.STRING)


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), NUMBERS)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


# ---- versions


def test_days_are_replaced_and_old_manifests_stay_readable(spark, root):
    assert not is_versioned(spark, root) and read_versioned(spark, root, NUMBERS).count() == 0
    replace_days(numbers(spark, (1, "20240101"), (2, "20240102"), (3, "20240103")), root)
    report = replace_days(numbers(spark, (20, "20240102")), root, asked=["20240102", "20240103"])
    assert report.days == ["20240102"] and report.rows == 1
    assert rows_of(read_versioned(spark, root, NUMBERS)) == [(1, "20240101"), (20, "20240102")]
    first = read_manifest(spark, root, 1)
    assert rows_of(read_versioned(spark, root, NUMBERS, manifest=first)) == [(1, "20240101"), (2, "20240102"), (3, "20240103")]
    assert rows_of(read_versioned(spark, root, NUMBERS, "20240102", "20240103")) == [(20, "20240102")]


def test_a_reader_sees_the_old_days_or_the_new_days(spark, root):
    """Both days change together, over and over, under a reader that loops."""
    replace_days(numbers(spark, (0, "20240101"), (0, "20240102")), root)
    seen, stop, errors = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted({row.n for row in read_versioned(spark, root, NUMBERS).collect()})))
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        replace_days(numbers(spark, (n, "20240101"), (n, "20240102")), root)
    stop.set()
    reader.join()
    assert not errors and seen and all(len(found) == 1 for found in seen)


def test_a_load_that_dies_leaves_no_trace(spark, root):
    replace_days(numbers(spark, (1, "20240101")), root)
    broken = numbers(spark, (2, "20240101"), (3, "20240102")).select(F.when(F.col("n") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("n")).cast("long").alias("n"), "partition")
    with pytest.raises(Exception, match="no"):
        replace_days(broken, root)
    assert rows_of(read_versioned(spark, root, NUMBERS)) == [(1, "20240101")] and read_manifest(spark, root).number == 1
    before = fingerprint(f"{root}/{read_manifest(spark, root).days['20240101'].folder}")
    vacuum(spark, root, grace_seconds=-60)
    assert len(matching(spark, f"{root}/load=*")) == 1
    assert fingerprint(f"{root}/{read_manifest(spark, root).days['20240101'].folder}") == before


def test_two_loads_that_finish_together_both_count(spark, root):
    replace_days(numbers(spark, (1, "20240101"), (2, "20240102")), root)
    tried = []

    def change(now):
        if not tried:  # another load is faster once
            replace_days(numbers(spark, (10, "20240101")), root)
        tried.append(now.number)
        return replace(now, days=now.days | replaced((), "load=x", empty=["20240102"]))

    after = commit(spark, root, change)
    assert tried == [1, 2] and after.number == 3
    assert rows_of(read_versioned(spark, root, NUMBERS)) == [(10, "20240101")]
    assert after.days["20240102"] == Day("")


def test_vacuum_keeps_what_kept_manifests_name(spark, root):
    for n in range(5):
        replace_days(numbers(spark, (n, "20240101")), root)
    assert vacuum(spark, root, keep=2) == 0 and len(matching(spark, f"{root}/manifests/*.json")) == 2
    assert vacuum(spark, root, keep=2, grace_seconds=-60) == 3
    assert rows_of(read_versioned(spark, root, NUMBERS, manifest=read_manifest(spark, root, 4))) == [(3, "20240101")]


def test_a_versioned_gold_table_stays_versioned(spark, lake, put_csv):
    put_sales(put_csv, "20241201", "a", "b")
    put_sales(put_csv, "20241202", "c")
    load_day(spark, lake, SALES, "20241201", versioned=True)
    load_day(spark, lake, SALES, "20241202")
    assert read_gold(spark, lake, SALES.gold).count() == 3
    assert read_gold_days(spark, lake, SALES.gold, "20241202", "20241202").count() == 1
    assert dict(rows_of(rows_per_day(spark, lake, SALES.gold, "20241201", "20241231"))) == {"20241201": 2, "20241202": 1}
    # A day without rows is replaced by nothing where the job writes such days.
    put_csv(PRODUCT.raw, "20241201", [])
    load_day(spark, lake, PRODUCT, "20241201", versioned=True)
    assert read_gold(spark, lake, PRODUCT.gold).count() == 0
    assert statuses(backfill(spark, lake, SALES, "20241201", "20241203"))["20241201"] == ("ok", 2)


# ---- backfill of changed days


def test_only_changed_days_are_loaded_again(spark, lake, put_csv):
    for day in ("20241201", "20241202", "20241204"):
        put_csv(STORE.raw, day, [STORE_LINE.format(n) for n in range(3)])
    put_csv(STORE.raw, "20241205", [])
    first = statuses(backfill_versions(spark, lake, STORE, "20241201", "20241205"))
    assert first == {"20241201": ("ok", 3), "20241202": ("ok", 3), "20241203": ("no_data", 0), "20241204": ("ok", 3), "20241205": ("emptied", 0)}
    before = read_manifest(spark, lake.gold(STORE.gold))
    again = statuses(backfill_versions(spark, lake, STORE, "20241201", "20241205", changed_only=True))
    assert {day: status for day, (status, _) in again.items()} == {
        "20241201": "unchanged", "20241202": "unchanged", "20241203": "no_data", "20241204": "unchanged", "20241205": "unchanged",
    }
    assert read_manifest(spark, lake.gold(STORE.gold)) == before
    put_csv(STORE.raw, "20241202", [STORE_LINE.format(9)], "part-1.csv")
    third = statuses(backfill_versions(spark, lake, STORE, "20241201", "20241205", changed_only=True))
    assert third["20241202"] == ("ok", 4) and third["20241201"] == ("unchanged", 0)
    after = read_manifest(spark, lake.gold(STORE.gold))
    assert {day for day in after.days if after.days[day] != before.days[day]} == {"20241202"}
    put_csv(SALES.raw, "20241201", [])
    with pytest.raises(EmptyInput):
        backfill_versions(spark, lake, SALES, "20241201", "20241205", on_empty="raise")


# ---- compaction


def test_packing():
    assert pack([], 10) == []
    bins = pack([6, 5, 5, 4, 30, 1], 10)
    held = {}
    for n, size in zip(bins, [6, 5, 5, 4, 30, 1]):
        held.setdefault(n, []).append(size)
    assert sorted(map(sorted, held.values())) == [[1], [4, 6], [5, 5], [30]]


def land(spark, lake, batch, *days):
    text = "\n".join(sales_line(process_date=day, store=f"s{batch}") for day in days)
    land_batch(spark.createDataFrame([(bytearray(text.encode()),)], "value BINARY"), batch, lake)


def test_compacted_days_hold_the_same_rows(spark, lake):
    for batch in range(6):
        land(spark, lake, batch, "2024-12-01", "2024-12-01", "2024-12-02", "2024-12-09")
    before = rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231"))
    marks = day_sources(spark, lake, TABLE, "20241201", "20241231")
    # The newest batch may be replayed, and the 9th is not finished.
    assert compact_landing(spark, lake, TABLE, "20241209") == ["20241201", "20241202"]
    assert rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231")) == before
    assert read_raw_day(spark, lake, TABLE, "20241201").count() == 12
    entry = read_manifest(spark, lake.raw(TABLE)).days["20241201"]
    assert entry.covers == ("0", "1", "2", "3", "4")
    assert len(file_states(spark, f"{lake.raw(TABLE)}/{entry.folder}/[!_.]*")) == 1
    assert compact_landing(spark, lake, TABLE, "20241209") == []
    # A replay of the newest batch replaces its own folder; a late batch lies beside the compacted day.
    land(spark, lake, 5, "2024-12-01", "2024-12-01", "2024-12-02", "2024-12-09")
    assert rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231")) == before
    assert drop_compacted(spark, lake, TABLE) == 0 and drop_compacted(spark, lake, TABLE, grace_seconds=-60) == 10
    assert rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231")) == before
    assert day_sources(spark, lake, TABLE, "20241201", "20241231") == marks
    land(spark, lake, 6, "2024-12-01")
    assert read_raw_day(spark, lake, TABLE, "20241201").count() == 13
    assert compact_landing(spark, lake, TABLE, "20241209", up_to=6) == ["20241201", "20241202"]
    assert read_raw_day(spark, lake, TABLE, "20241201").count() == 13
    changed = day_sources(spark, lake, TABLE, "20241201", "20241231")
    assert {day for day in changed if changed[day] != marks[day]} == {"20241201"}


def test_files_of_a_compacted_day_are_bounded_by_bytes(spark, lake):
    for batch in range(8):
        land(spark, lake, batch, *["2024-12-01"] * 20)
    sizes = [state.length for state in file_states(spark, f"{lake.raw(TABLE)}/partition=20241201/batch_id=*/[!_.]*")]
    target = 3 * max(sizes)
    compact_landing(spark, lake, TABLE, "20241231", up_to=7, target_bytes=target)
    entry = read_manifest(spark, lake.raw(TABLE)).days["20241201"]
    written = [state.length for state in file_states(spark, f"{lake.raw(TABLE)}/{entry.folder}/[!_.]*")]
    assert len(written) <= -(-2 * sum(sizes) // target) and sum(written) == sum(sizes)
    assert read_raw_day(spark, lake, TABLE, "20241201").count() == 160


def test_packed_days_stay_packed_and_are_compacted_in_parts(spark, lake, monkeypatch):
    days = ["2024-12-01", "2024-12-01", "2024-12-02", "2024-12-03"]
    for batch in range(3):
        lines = [(sales_line(process_date=day, store=f"s{batch}").encode(),) for day in days]
        land_batch(spark.createDataFrame(lines, "value BINARY"), batch, lake, compression="gzip")
    land(spark, lake, 3, *days)  # a plain batch beside them
    before = rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231"))
    monkeypatch.setattr(compaction, "MOST_BYTES", 1)
    assert len(compact_landing(spark, lake, TABLE, "20241231", up_to=3)) == 3
    root, held = lake.raw(TABLE), read_manifest(spark, lake.raw(TABLE)).days
    assert len({entry.folder.partition("/")[0] for entry in held.values()}) == 3  # a day a part
    files = [state.path for entry in held.values() for state in file_states(spark, f"{root}/{entry.folder}/[!_.]*")]
    assert len(files) == 3 and all(path.endswith(".gz") for path in files)
    assert drop_compacted(spark, lake, TABLE, grace_seconds=-60) == 12
    assert rows_of(read_raw_days(spark, lake, TABLE, "20241201", "20241231")) == before


# ---- folds by day


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "messages")


@pytest.fixture
def store(tmp_path):
    return TotalsStore(str(tmp_path / "totals"))


def assert_levelled(spark, feed, store, mode):
    for table in schemas.TOTAL_GRAINS:
        assert rows_of(current_totals(spark, store, table, mode)) == rows_of(totals(feed.batch(), table))


@pytest.mark.parametrize("mode", ["delta", "state"])
def test_a_fold_rewrites_the_days_it_touches(spark, feed, store, tmp_path, mode):
    options = {"state_partitions": 2} if mode == "state" else {}
    feed.add(BATCHES[0])
    feed.add([{"process_date": "2024-12-05"}, {"process_date": "no date"}])
    feed.add([{"process_date": "2024-12-05", "sale_bottles": 7}])
    feed.add(BATCHES[2])
    drain(feed, store, tmp_path, mode=mode, **options)
    assert fold_days(spark, store, 1, mode) == ["20241201", "20241205", "none"]
    assert_levelled(spark, feed, store, mode)
    root = levels_root(store, mode)
    before = read_manifest(spark, root)
    untouched = {day: fingerprint(f"{root}/{before.days[day].folder}") for day in ("20241201", "none")}
    # The next batch touches one day: its files are new, the others' are the same files.
    assert fold_days(spark, store, 2, mode) == ["20241205"]
    after = read_manifest(spark, root)
    assert {day for day in after.days if after.days[day] != before.days[day]} == {"20241205"}
    assert {day: fingerprint(f"{root}/{after.days[day].folder}") for day in untouched} == untouched
    assert days_up_to(folded_days(spark, store, mode)) == 2 and fold_days(spark, store, 2, mode) == []
    assert drop_levelled(spark, store, mode) == 3
    assert_levelled(spark, feed, store, mode)
    feed.add([{"sale_bottles": 3, "hour_id": "23"}])
    drain(feed, store, tmp_path, mode=mode, **options)
    assert_levelled(spark, feed, store, mode)


def test_folded_days_of_a_replaced_run_count_no_more(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    fold_days(spark, store)
    again = Feed(spark, tmp_path / "again")
    again.add([{"sale_bottles": 1}])
    (tmp_path / "other").mkdir()
    drain(again, store, tmp_path / "other", new_checkpoint="replace")
    assert days_up_to(folded_days(spark, store, "delta")) == -1
    assert_levelled(spark, again, store, "delta")
    again.add([{"sale_bottles": 2}])
    drain(again, store, tmp_path / "other")
    assert fold_days(spark, store) == ["20241201"]
    assert_levelled(spark, again, store, "delta")


def test_a_store_is_folded_one_way(spark, feed, store, tmp_path):
    feed.add(BATCHES[0])
    feed.add(BATCHES[1])
    drain(feed, store, tmp_path)
    fold(spark, store)
    with pytest.raises(ValueError, match="as a whole"):
        fold_days(spark, store)


def test_a_store_that_is_folded_by_day_is_not_folded_as_a_whole(spark, feed, store, tmp_path):
    feed.add(BATCHES[0])
    feed.add(BATCHES[1])
    drain(feed, store, tmp_path)
    fold_days(spark, store)
    with pytest.raises(ValueError, match="by day"):
        fold(spark, store)
