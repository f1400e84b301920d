import glob
import gzip
import os
import shutil
import signal
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from tests.conftest import rows_of, sales_line
from tillflow import schemas
from tillflow.operators.totals import COMMON_KEYS, merge_deltas, totals
from tillflow.session import session_conf
from tillflow.sinks.logs import compact_batch_log, read_batch_log
from tillflow.sources.messages import kafka_messages, parquet_messages, parse_sales, whole_file_messages
from tillflow.sources.raw import read_raw_days
from tillflow.streaming import current
from tillflow.streaming.current import (
    create_current_view,
    current_totals,
    drop_folded,
    fold,
    late_totals,
    publish_view,
    state_totals,
)
from tillflow.streaming.debug import print_totals, start_memory_totals
from tillflow.streaming import landing
from tillflow.streaming.landing import REJECTS, TABLE, land_batch, start_landing
from tillflow.streaming.levels import fold_days
from tillflow.streaming.progress import BatchLog
from tillflow.streaming.totals import ROCKSDB, TotalsStore, run_until_stopped, start_totals

BATCHES = [
    [{"sale_bottles": 10}, {"name": None, "city": None}, {"state_bottle_cost": None, "hour_id": "11"}],
    [{"sale_bottles": 5}, {"vendor_name": None, "im_desc": None}, {"hour_id": "11"}],
    [{"name": "Other", "process_date": "2024-12-02"}, {"sale_bottles": "oops"}],
]


class Feed:
    """Message files for a stream, one message each."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, str(folder), 0
        os.makedirs(self.folder)

    def add(self, lines, text=None):
        text = "\n".join(sales_line(**line) for line in lines) + "\n" if text is None else text
        path = f"{self.folder}/{self.count:04}.txt"
        with open(path, "w") as file:
            file.write(text)
        os.utime(path, (1_700_000_000 + self.count,) * 2)
        self.count += 1

    def stream(self):
        return whole_file_messages(self.spark, f"{self.folder}/*.txt", max_files_per_trigger=1)

    def batch(self):
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/*.txt")
        return parse_sales(files.select(F.col("content").alias("value")))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "messages")


@pytest.fixture
def store(tmp_path):
    return TotalsStore(str(tmp_path / "totals"))


def drain(feed, store, tmp_path, **options):
    query = start_totals(feed.stream(), store, str(tmp_path / "checkpoint"), every=None, **options)
    query.awaitTermination()
    return query


def assert_totals(spark, feed, store, mode="delta", output="update"):
    sales = feed.batch()
    for table in schemas.TOTAL_GRAINS:
        found = current_totals(spark, store, table, mode, output)
        assert found.schema.names == schemas.totals_schema(table).names
        assert rows_of(found) == rows_of(totals(sales, table))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false"
MODES = [("delta", {}), ("state", {"output": "update"}), ("state", {"output": "complete"})]


@pytest.mark.parametrize("mode, options", MODES)
def test_stream_equals_batch_also_after_restart(spark, feed, store, tmp_path, mode, options):
    feed.add(BATCHES[0])
    feed.add(BATCHES[1])
    drain(feed, store, tmp_path, mode=mode, state_partitions=2, **options)
    assert_totals(spark, feed, store, mode, **options)
    feed.add(BATCHES[2])
    drain(feed, store, tmp_path, mode=mode, **options)
    assert_totals(spark, feed, store, mode, **options)


def test_rocksdb_state(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path, mode="state", state_partitions=2, state_provider=ROCKSDB)
    assert_totals(spark, feed, store, "state")


def test_replayed_batch_changes_nothing(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    commits = sorted(glob.glob(f"{tmp_path}/checkpoint/commits/[0-9]*"))
    assert len(commits) == 3
    # A driver that died before the commit: the last batch runs again.
    for mark in (commits[-1], f"{tmp_path}/checkpoint/commits/.2.crc"):
        if os.path.exists(mark):
            os.remove(mark)
    drain(feed, store, tmp_path)
    assert_totals(spark, feed, store)
    assert read_batch_log(spark, store.log).count() == 9


def test_running_total_is_not_counted_twice(spark, feed, store, tmp_path):
    feed.add([{"sale_bottles": 10}])
    feed.add([{"sale_bottles": 5}])
    drain(feed, store, tmp_path)
    create_current_view(spark, store, "f001_store_tot_sales")
    assert spark.sql("SELECT sale_bottles FROM f001_store_tot_sales").first()[0] == 15


def test_fold(spark, feed, store, tmp_path):
    for batch in BATCHES[:2]:
        feed.add(batch)
    drain(feed, store, tmp_path)
    assert fold(spark, store) == 0
    assert fold(spark, store) == 0
    assert_totals(spark, feed, store)
    feed.add(BATCHES[2])
    drain(feed, store, tmp_path)
    assert fold(spark, store, up_to=2) == 2
    assert_totals(spark, feed, store)
    # A base that was never finished is not read.
    os.makedirs(f"{store.base}/up_to=9/table_name=x")
    assert_totals(spark, feed, store)
    os.rmdir(f"{store.base}/up_to=9/table_name=x")
    os.rmdir(f"{store.base}/up_to=9")
    feed.add(BATCHES[0])
    drain(feed, store, tmp_path)
    assert drop_folded(spark, store) == 3
    assert_totals(spark, feed, store)


def test_batch_log(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    log = read_batch_log(spark, store.log)
    assert log.schema.names == schemas.STREAM_LOG.names
    rows = log.collect()
    assert len(rows) == 9
    assert {r["status"] for r in rows} == {"succeed"}
    assert all(r["record_count"] == 1 and r["processing_time_seconds"] > 0 for r in rows)
    assert all(r["batch_start_time"] <= r["batch_end_time"] for r in rows)


def test_failed_batch_is_logged_and_replayed(spark, feed, store, tmp_path):
    feed.add(BATCHES[0])
    blocked = TotalsStore(store.root)
    os.makedirs(store.root)
    with open(blocked.deltas, "w") as file:
        file.write("in the way")
    with pytest.raises(StreamingQueryException):
        drain(feed, blocked, tmp_path)
    log = read_batch_log(spark, store.log)
    assert {(r["status"], r["batch_id"]) for r in log.collect()} == {("error", 0)}
    assert log.first()["error_details"]
    os.remove(blocked.deltas)
    drain(feed, store, tmp_path)
    assert_totals(spark, feed, store)
    statuses = read_batch_log(spark, store.log).groupBy("status").count()
    assert rows_of(statuses) == [("error", 3), ("succeed", 3)]


@pytest.mark.parametrize("mode", ["delta", "state"])
def test_more_batches_than_spark_remembers_are_all_logged(spark, feed, store, tmp_path, mode):
    with session_conf(spark, {"spark.sql.streaming.numRecentProgressUpdates": 2}):
        for _ in range(5):
            feed.add(BATCHES[0])
        drain(feed, store, tmp_path, mode=mode, state_partitions=1)
    log = read_batch_log(spark, store.log)
    assert rows_of(log.where("table_name like 'f001%'"), "batch_id", "record_count") == [(n, 1) for n in range(5)]


def test_a_failed_state_batch_has_an_error_row(spark, feed, store, tmp_path):
    feed.add(BATCHES[0])
    os.makedirs(store.root)
    with open(store.snapshots, "w") as file:
        file.write("in the way")
    with pytest.raises(StreamingQueryException):
        drain(feed, store, tmp_path, mode="state", state_partitions=1)
    assert {(r["status"], r["batch_id"]) for r in read_batch_log(spark, store.log).collect()} == {("error", 0)}


def test_compacted_log(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    assert read_batch_log(spark, store.log).count() == 0
    drain(feed, store, tmp_path)
    before = rows_of(read_batch_log(spark, store.log))
    assert compact_batch_log(spark, store.log, "2000-01-01") == 0
    assert compact_batch_log(spark, store.log, "2999-01-01") == 3
    assert rows_of(read_batch_log(spark, store.log)) == before and len(before) == 9
    assert len(glob.glob(f"{store.log}/days/day=*/part-*")) == 1
    feed.add(BATCHES[0])
    drain(feed, store, tmp_path)
    assert read_batch_log(spark, store.log).count() == 12


@pytest.mark.parametrize("folded", [False, True])
def test_new_checkpoint_with_new_messages(spark, store, tmp_path, folded):
    first, second = Feed(spark, tmp_path / "first"), Feed(spark, tmp_path / "second")
    for _ in range(3):
        first.add([{"sale_bottles": 10}])
    drain(first, store, tmp_path / "a")
    if folded:
        fold(spark, store)
    second.add([{"sale_bottles": 1000}])
    with pytest.raises(ValueError, match="another checkpoint"):
        drain(second, store, tmp_path / "b")
    drain(second, store, tmp_path / "b", new_checkpoint="continue")
    total = lambda: current_totals(spark, store, "f001_store_tot_sales").first()["sale_bottles"]
    assert total() == 1030
    second.add([{"sale_bottles": 1}])
    drain(second, store, tmp_path / "b")  # a restart finds its run again
    assert total() == 1031
    fold(spark, store)
    assert total() == 1031
    drop_folded(spark, store)
    assert total() == 1031


@pytest.mark.parametrize("mode, options", MODES)
@pytest.mark.parametrize("folded", [False, True])
def test_full_replay_through_a_new_checkpoint(spark, feed, store, tmp_path, mode, options, folded):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path / "a", mode=mode, state_partitions=1, **options)
    if folded and options.get("output") != "complete":
        fold(spark, store, mode=mode)
    drain(feed, store, tmp_path / "b", mode=mode, state_partitions=1, new_checkpoint="replace", **options)
    assert_totals(spark, feed, store, mode, **options)
    if options.get("output") != "complete":
        fold(spark, store, mode=mode)
        drop_folded(spark, store, mode)
        assert_totals(spark, feed, store, mode, **options)


def test_state_cannot_continue(feed, store, tmp_path):
    feed.add(BATCHES[0])
    with pytest.raises(ValueError):
        drain(feed, store, tmp_path, mode="state", new_checkpoint="continue")


@pytest.mark.parametrize("mode, options", MODES)
def test_totals_before_the_first_batch_are_empty(spark, store, mode, options):
    for table in schemas.TOTAL_GRAINS:
        found = current_totals(spark, store, table, mode, **options)
        assert found.schema.names == schemas.totals_schema(table).names and found.count() == 0


def test_published_view(spark, feed, store, tmp_path):
    view, table = f"totals_{uuid.uuid4().hex}", "f001_store_tot_sales"
    for batch in BATCHES:
        feed.add(batch)
        drain(feed, store, tmp_path)
        publish_view(spark, store, table, view)
        assert rows_of(spark.sql(f"SELECT * FROM {view}")) == rows_of(totals(feed.batch(), table))
    assert len(glob.glob(f"{store.root}/current/{table}/as_of=*")) == 2
    spark.sql(f"DROP VIEW {view}")


def test_superseded_bases_go(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    assert [fold(spark, store, up_to=n) for n in (0, 1)] == [0, 1]
    assert drop_folded(spark, store) == 2
    assert [os.path.basename(p) for p in glob.glob(f"{store.base}/*")] == ["up_to=1"]
    assert_totals(spark, feed, store)


def test_stop_on_signal(spark, feed, store, tmp_path):
    feed.add(BATCHES[0])
    run_until_stopped(drain(feed, store, tmp_path))
    feed.add(BATCHES[1])
    query = start_totals(feed.stream(), store, str(tmp_path / "checkpoint"), every="1 second")
    threading.Timer(8, os.kill, [os.getpid(), signal.SIGTERM]).start()
    run_until_stopped(query)
    assert not query.isActive
    assert_totals(spark, feed, store)


def test_unknown_mode(feed, store, tmp_path):
    feed.add(BATCHES[0])
    with pytest.raises(ValueError):
        drain(feed, store, tmp_path, mode="other")


def test_memory_totals(spark, feed, tmp_path, capsys):
    feed.add(BATCHES[0])
    feed.add(BATCHES[1])
    table = "f002_vendor_tot_sales"
    start_memory_totals(feed.stream(), table, str(tmp_path / "memory")).awaitTermination()
    assert rows_of(spark.table(table)) == rows_of(totals(feed.batch(), table))
    print_totals(spark.table(table))
    assert "vendor_name" in capsys.readouterr().out


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "broker:9092", "liquor_sales")


def test_parquet_messages(spark, store, tmp_path):
    line = sales_line()
    frame = spark.createDataFrame([(line.encode(),), (None,), (b"\n",)], "value BINARY")
    frame.write.parquet(str(tmp_path / "rows"))
    stream = parquet_messages(spark, str(tmp_path / "rows"))
    start_totals(stream, store, str(tmp_path / "checkpoint"), every=None).awaitTermination()
    assert current_totals(spark, store, "f001_store_tot_sales").first()["sale_bottles"] == 2


# ---- landing


def test_landing(spark, feed, lake, tmp_path):
    feed.add([{"sale_bottles": "oops"}, {"name": '"Shop, North"', "process_date": "2024-12-02"}])
    short = ",".join(sales_line().split(",")[:7])
    feed.add([], text=sales_line(store="s9") + "\r\n\r\nno such line\r\n" + sales_line(process_date=""))
    feed.add([], text=short + "\n" + sales_line() + ",one too many\n")

    def run():
        checkpoint = str(tmp_path / "landing")
        start_landing(feed.stream(), lake, checkpoint, every=None).awaitTermination()
        landed = read_raw_days(spark, lake, TABLE, "20241201", "20241231")
        return rows_of(landed, "partition", "store", "name", "sale_bottles", "sale_gallons")

    expected = [
        ("20241201", "s1", "Corner Shop", None, 0.5),
        ("20241201", "s9", "Corner Shop", 2, 0.5),
        ("20241202", "s1", "Shop, North", 2, 0.5),
    ]
    assert run() == expected
    rejects = spark.read.text(lake.raw(REJECTS))
    assert rows_of(rejects, "value") == sorted(
        (line,) for line in ("no such line", sales_line(process_date=""), short, sales_line() + ",one too many")
    )
    # Lines are kept as they came, wrong numbers included.
    kept = spark.read.text(f"{lake.raw(TABLE)}/partition=20241201/batch_id=0")
    assert rows_of(kept, "value") == [(sales_line(sale_bottles="oops"),)]
    os.remove(f"{tmp_path}/landing/commits/1")
    crc = f"{tmp_path}/landing/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert run() == expected


def test_a_log_that_is_not_whole_is_an_error(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), "late", 0)
    with pytest.raises(TimeoutError):
        log.finish(0.01)
    assert log.listening
    log.ended.set()
    log.finish(0.01)
    assert not log.listening


LATE = [
    [{"process_date": "2024-12-10", "hour_id": "12"}, {"process_date": "2024-12-01"}],
    [{"process_date": "2024-12-08", "hour_id": "12", "sale_bottles": 3}, {"process_date": "2024-12-08", "hour_id": "11"}, {"process_date": "no date"}],
    [{"process_date": "2024-12-20", "hour_id": "x"}],
    [{"process_date": "2024-12-17"}, {"process_date": "2024-12-18"}, {"process_date": "2024-12-01", "sale_bottles": 9}],
]


def test_late_totals_are_kept_aside(spark, feed, store, tmp_path):
    """The limit is two days behind the batches before: 8th, 12 h; then the 18th, 0 h."""
    for batch in LATE:
        feed.add(batch)
    drain(feed, store, tmp_path, late_after="2 days")
    table = "f002_vendor_tot_sales"
    late = [(str(day), hour, n) for day, hour, n in rows_of(late_totals(spark, store, table), "prd_id", "hour_id", "sale_bottles")]
    assert late == [("2024-12-01", "08", 9), ("2024-12-08", "11", 2), ("2024-12-17", "08", 2)]
    both = current_totals(spark, store, table).unionByName(late_totals(spark, store, table))
    assert rows_of(merge_deltas(both, COMMON_KEYS + ["vendor_name"])) == rows_of(totals(feed.batch(), table))
    # A replay of the last batch finds the marks that it found.
    for mark in ("3", ".3.crc"):
        if os.path.exists(f"{tmp_path}/checkpoint/commits/{mark}"):
            os.remove(f"{tmp_path}/checkpoint/commits/{mark}")
    drain(feed, store, tmp_path, late_after="2 days")
    assert [(str(d), h, n) for d, h, n in rows_of(late_totals(spark, store, table), "prd_id", "hour_id", "sale_bottles")] == late


def test_state_forgets_what_is_past_its_watermark(spark, feed, store, tmp_path):
    for batch in LATE:
        feed.add(batch)
    query = drain(feed, store, tmp_path, mode="state", state_partitions=2, late_after="2 days")
    assert query.late_rows > 0
    checkpoint = str(tmp_path / "checkpoint")
    held = {str(day) for (day,) in rows_of(state_totals(spark, checkpoint, "f001_store_tot_sales"), "prd_id")}
    # The date that is none has no event time and stays.
    assert held == {"2024-12-18", "2024-12-20", "None"}
    # Spark drops what was late a batch before: the 17th still counts, the late line of the 1st does not.
    published = rows_of(current_totals(spark, store, "f001_store_tot_sales", "state"), "prd_id", "sale_bottles")
    days = {str(day) for day, _ in published}
    assert days == {"2024-12-01", "2024-12-08", "2024-12-10", "2024-12-17", "2024-12-18", "2024-12-20", "None"}
    assert [n for day, n in published if str(day) == "2024-12-01"] == [2]


def test_state_holds_the_totals(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path, mode="state", state_partitions=2)
    for table in schemas.TOTAL_GRAINS:
        assert rows_of(state_totals(spark, str(tmp_path / "checkpoint"), table)) == rows_of(totals(feed.batch(), table))


def test_complete_output_forgets_nothing(feed, store, tmp_path):
    feed.add(BATCHES[0])
    with pytest.raises(ValueError, match="late"):
        drain(feed, store, tmp_path, mode="state", output="complete", late_after="2 days")


def test_state_adds_changes_to_the_checkpoint(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path, mode="state", state_partitions=1)
    names = [os.path.basename(path) for path in glob.glob(f"{tmp_path}/checkpoint/state/0/0/*")]
    assert len([name for name in names if name.endswith(".changelog")]) == len(BATCHES)


def test_complete_output_keeps_the_newest_two_batches(spark, feed, store, tmp_path):
    for batch in [*BATCHES, BATCHES[0]]:
        feed.add(batch)
    drain(feed, store, tmp_path, mode="state", output="complete", state_partitions=1)
    left = sorted(path.rpartition("=")[2] for path in glob.glob(f"{store.snapshots}/batch_id=*"))
    assert left == ["2", "3"]
    assert_totals(spark, feed, store, "state", "complete")


def test_landing_parses_a_line_once(spark, lake, monkeypatch):
    seen, found = spark.sparkContext.accumulator(0), landing.lines_of
    count = F.udf(lambda line: (seen.add(1), line)[1]).asNondeterministic()
    monkeypatch.setattr(landing, "lines_of", lambda messages: found(messages).select(count("line").alias("line")))
    lines = [sales_line(), sales_line(process_date="soon"), sales_line(process_date="2024-12-02"), "short,2024-12-01"]
    messages = spark.createDataFrame([(line.encode(),) for line in lines], "value BINARY")
    land_batch(messages, 0, lake)
    assert seen.value == 4
    assert read_raw_days(spark, lake, TABLE, "20241201", "20241202").count() == 2
    assert spark.read.text(lake.raw(REJECTS)).count() == 2
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_a_stream_without_state_sums_in_the_partitions_of_the_session(spark, feed, store, tmp_path):
    feed.add([{"name": f"Shop {n}", "vendor_name": f"V {n}", "im_desc": f"P {n}"} for n in range(20)])
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        drain(feed, store, tmp_path, state_partitions=1)
    assert len(glob.glob(f"{store.root}/delta/batch_id=0/*/*.parquet")) > 3  # a file a table and partition


def shuffles_left(spark, before):
    """Shuffles that are there and were not before. Spark removes them aside, so it is given some time."""
    for _ in range(50):
        left = shuffles(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def shuffles(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet().mkString(",")
    return set(filter(None, held.split(",")))


@pytest.mark.parametrize("mode, options", MODES)
def test_shuffle_files_go_with_their_batch(spark, feed, store, tmp_path, mode, options):
    for batch in BATCHES:
        feed.add(batch)
    before = shuffles(spark)
    drain(feed, store, tmp_path, mode=mode, state_partitions=2, **options)
    assert not shuffles_left(spark, before)
    assert spark.conf.get(*CLEANUP) == CLEANUP[1]
    assert_totals(spark, feed, store, mode, **options)


def test_shuffle_files_go_with_the_fold(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    by_day = TotalsStore(f"{tmp_path}/by_day")
    shutil.copytree(store.deltas, by_day.deltas)
    shutil.copytree(f"{store.root}/runs", f"{by_day.root}/runs")
    before = shuffles(spark)
    publish_view(spark, store, "f001_store_tot_sales", view := f"view_{uuid.uuid4().hex}")
    spark.sql(f"DROP VIEW {view}")
    assert fold(spark, store) == 1 and not shuffles_left(spark, before)
    # The days are collected first, by a plain query of the session.
    days = fold_days(spark, by_day)
    assert days and len(shuffles_left(spark, before)) <= 1
    assert_totals(spark, feed, store)
    assert_totals(spark, feed, by_day)


def test_landed_lines_are_packed(spark, feed, lake, tmp_path):
    before = shuffles(spark)
    feed.add([{}, {"process_date": "soon"}, {"name": '"Shop, North"'}])
    feed.add([{"process_date": "2024-12-02"}, {}])
    start_landing(feed.stream(), lake, str(tmp_path / "landing"), every=None).awaitTermination()
    assert not shuffles_left(spark, before)
    for table, lines in ((f"{TABLE}/partition=*", 4), (REJECTS, 1)):
        files = glob.glob(f"{lake.raw(table)}/batch_id=*/part-*")
        assert files and all(file.endswith(".gz") for file in files)
        assert sum(len(gzip.open(file, "rt").read().splitlines()) for file in files) == lines
    assert read_raw_days(spark, lake, TABLE, "20241201", "20241231").count() == 4
    assert spark.read.text(lake.raw(REJECTS)).count() == 1


def test_state_is_packed_and_looks_a_key_up_once(spark, feed, store, tmp_path):
    for batch in BATCHES:
        feed.add(batch)
    query = drain(feed, store, tmp_path, mode="state", state_partitions=1)
    states = [progress.stateOperators[0] for progress in query.recentProgress if progress.numInputRows]
    assert sum(state.numRowsUpdated for state in states) > 0 and {state.numRowsTotal for state in states} == {0}  # not counted
    (newest,) = glob.glob(f"{tmp_path}/checkpoint/state/0/0/3.changelog")
    assert open(newest, "rb").read(4) == bytes.fromhex("28b52ffd")  # zstd


def test_fold_writes_a_table_at_a_time_and_counts_when_whole(spark, feed, store, tmp_path, monkeypatch):
    for batch in BATCHES:
        feed.add(batch)
    drain(feed, store, tmp_path)
    merged, seen = current.merge_deltas, []

    def dies(rows, keys):
        if len(seen) == 2:
            raise RuntimeError("no more")
        seen.append(keys)
        return merged(rows, keys)

    with monkeypatch.context() as patch:
        patch.setattr(current, "merge_deltas", dies)
        with pytest.raises(RuntimeError):
            fold(spark, store)
    assert seen == [COMMON_KEYS + ["store_name", "store_city"], COMMON_KEYS + ["vendor_name"]]
    assert current.folded_up_to(spark, store) == -1
    assert_totals(spark, feed, store)
    assert fold(spark, store) == 1 and current.folded_up_to(spark, store) == 1
    assert_totals(spark, feed, store)
