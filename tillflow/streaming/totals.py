"""Running totals from a message stream, all three tables from one query.

mode="delta" (default): each micro-batch writes its own sums under its batch id and keeps no state.
Current totals are the sum over batches. A replayed batch replaces its own folder, so the totals
stay exact, and memory does not grow with the number of keys.

mode="state": Spark keeps the totals as streaming state and publishes the changed keys (output
"update") or every key (output "complete") under the batch id. Current totals are the newest value
of each key. `state_totals` reads them out of the state itself.

late_after (off by default) says how far the event time of a line, its day and hour, may lie behind the
latest one of the batches before. In mode "state" Spark forgets totals that are older, so the state is
bounded by the distance; late lines are dropped, and `LoggedQuery.late_rows` counts the totals they
would have changed. In mode "delta" late totals are kept aside under their batch id: `late_totals`.
"""

from __future__ import annotations

import signal
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.files import delete_folders, make_folder, matching
from tillflow.operators.totals import all_totals, event_time, with_event_time
from tillflow.session import TIDY, session_conf
from tillflow.sources.messages import parse_sales
from tillflow.streaming.progress import BatchLog, LoggedQuery
from tillflow.streaming.runs import first_id, first_valid

# A batch of state adds the keys it changed to the checkpoint; without this it adds every file that RocksDB
# wrote anew, compactions of the whole state among them. A restart needs the newest batch only. To count the keys
# Spark looks each up once more before it is written, and the cache of a partition holds 8 MB by default.
STATE_FILES = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "4",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "32",
}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class TotalsStore:
    """Folders of one running-totals store."""

    root: str

    @property
    def deltas(self) -> str:
        return f"{self.root}/delta"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshot"

    @property
    def base(self) -> str:
        return f"{self.root}/base"

    @property
    def snapshot_base(self) -> str:
        return f"{self.root}/snapshot_base"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    @property
    def marks(self) -> str:
        return f"{self.root}/marks"

    @property
    def log(self) -> str:
        return f"{self.root}/streaming_logs"


def _publish(totals: DataFrame, folder: str, batch_id: int) -> None:
    """A batch owns its folder; writing it again replaces it."""
    totals.write.mode("overwrite").partitionBy("table_name").parquet(f"{folder}/batch_id={batch_id}")


def _drop_superseded(spark: SparkSession, store: TotalsStore, first: int, newest: int) -> None:
    """Delete the run's batches before the last two: each held every key. A reader of the last but one is
    not disturbed."""
    found = matching(spark, f"{store.snapshots}/batch_id=*")
    delete_folders(spark, [path for path in found if first <= int(path.rpartition("=")[2]) < newest - 1])


def _latest_before(spark: SparkSession, store: TotalsStore, batch_id: int) -> int | None:
    """Latest event time of the batches before, in seconds. A mark is a folder name, written before
    the batch is: a replayed batch finds the marks it found."""
    marks = [path.rpartition("batch_id=")[2].split("/latest=") for path in matching(spark, f"{store.marks}/batch_id=*/latest=*")]
    valid = first_valid(spark, store.root)
    return max((int(latest) for batch, latest in marks if valid <= int(batch) < batch_id), default=None)


def _publish_timely(totals: DataFrame, store: TotalsStore, batch_id: int, late_after: str) -> None:
    """Publish a batch's totals, those aside that lie too far behind the batches before it."""
    spark = totals.sparkSession
    latest = _latest_before(spark, store, batch_id)
    totals = totals.persist()  # sums by hour, read three times
    try:
        seconds = F.unix_timestamp(event_time(F.col("prd_id"), F.col("hour_id")))
        newest = totals.agg(F.max(seconds)).first()[0]
        if newest is not None:
            make_folder(spark, f"{store.marks}/batch_id={batch_id}/latest={newest}")
        late = F.lit(False)
        if latest is not None:
            limit = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {late_after}")
            late = F.coalesce(seconds < F.unix_timestamp(limit), F.lit(False))
        _publish(totals.where(late), store.late, batch_id)
        _publish(totals.where(~late), store.deltas, batch_id)
    finally:
        totals.unpersist()


def start_totals(
    messages: DataFrame,
    store: TotalsStore,
    checkpoint: str,
    mode: str = "delta",
    output: str = "update",
    every: str | None = "1 minute",
    keep_blank: bool = False,
    lenient_dates: bool = False,
    state_partitions: int | None = None,
    state_provider: str | None = ROCKSDB,
    name: str = "running_totals",
    new_checkpoint: str = "refuse",
    late_after: str | None = None,
) -> LoggedQuery:
    """Start the query; the caller keeps the handle. every=None drains what is there and stops.

    state_partitions and state_provider apply to mode="state"; the number of state partitions is
    fixed by the first run of a checkpoint. new_checkpoint says what a checkpoint without history
    does to a store that holds batches: "refuse", "continue" (mode="delta" only, for messages no
    run has read yet) or "replace". late_after: an interval like "2 days".
    """
    if mode not in ("delta", "state"):
        raise ValueError(f"unknown mode: {mode}")
    if mode == "state" and new_checkpoint == "continue":
        raise ValueError("new state starts from nothing: it cannot continue earlier totals")
    if late_after and mode == "state" and output != "update":
        raise ValueError("only output update forgets late totals: complete publishes every key")
    spark = messages.sparkSession
    first = first_id(spark, store.root, checkpoint, new_checkpoint)
    if mode == "delta":

        def publish(batch: DataFrame, batch_id: int) -> None:
            totals = all_totals(parse_sales(batch, keep_blank), lenient_dates)
            if late_after:
                _publish_timely(totals, store, first + batch_id, late_after)
            else:
                _publish(totals, store.deltas, first + batch_id)

        writer = messages.writeStream.foreachBatch(publish)
    else:

        def publish(batch: DataFrame, batch_id: int) -> None:
            _publish(batch, store.snapshots, first + batch_id)
            if output == "complete":
                _drop_superseded(spark, store, first, first + batch_id)

        sales = parse_sales(messages, keep_blank)
        if late_after:
            sales = with_event_time(sales, late_after, lenient_dates)
        totals = all_totals(sales, lenient_dates)
        writer = totals.writeStream.outputMode(output).foreachBatch(publish)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    settings = dict(TIDY)
    if mode == "state":
        # Without state nothing is bound to a number: a batch is summed in the partitions of the session.
        settings |= {"spark.sql.shuffle.partitions": state_partitions, "spark.sql.streaming.stateStore.providerClass": state_provider, **STATE_FILES}
    log = BatchLog(spark, store.log, name, first)
    with session_conf(spark, settings):
        query = (
            writer.queryName(name)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    return LoggedQuery(query, log)


def run_until_stopped(query: LoggedQuery) -> None:
    """Wait for the query; SIGTERM or SIGINT stops it without killing the driver."""
    asked = threading.Event()
    numbers = (signal.SIGTERM, signal.SIGINT)
    before = {number: signal.signal(number, lambda *_: asked.set()) for number in numbers}
    try:
        while not asked.is_set() and not query.awaitTermination(1):
            pass
        if asked.is_set():
            query.stop()
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
