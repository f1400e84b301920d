"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Shuffle files go with the job that wrote them. Otherwise they stay until the driver collects its garbage, and
#: a stream adds those of every batch.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# AQE sizes shuffles, splits skewed joins and skewed rebalances; nothing here depends on the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that holds a few days writes them side by side instead of sorting its rows by day.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.ui.enabled": "false",
}


def spark_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder for one run under the shared checkpoint folder the cluster names.

    Only a master of one process may fall back to a temporary folder of the machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tillflow-")
        spark.conf.set(CHECKPOINT_DIR, shared)
    return f"{shared.rstrip('/')}/tillflow/{uuid.uuid4().hex}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str | int | None]):
    """Set session options for the block; a value of None leaves the option alone."""
    settings = {key: str(value) for key, value in settings.items() if value is not None}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
