"""Tables of days that change by a single rename.

    {root}/load=<id>/partition=<day>/…    what one load wrote; never changed
    {root}/manifests/<number>.json        which load every day is read from

A load writes a folder of its own, then a manifest that names it. The manifest appears whole under
the next number, so a reader sees the days of the old one or of the new one, and a load that dies
leaves nothing that a reader looks at. Two loads that finish together both try the next number: the
one that comes late reads the manifest that was faster, changes it in the days it wrote, and tries the
number after. A day both wrote is the later one's.

Manifests hold a line per day and a few notes, whatever the size of the days. Folders that no kept
manifest names are deleted by `vacuum`, once no reader or load of them can be running.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillflow.files import delete_folder, file_states, make_folder, matching, read_text, write_new

KEEP = 10
GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Day:
    """folder: where the day lies below the root, "" for a day without rows; source: what it was made
    from, in the loader's words; covers: what a compacted day holds of folders that stay beside it."""

    folder: str
    source: str = ""
    covers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    days: dict[str, Day] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    def folders(self, root: str, start: str = "", end: str = "~") -> list[str]:
        """Folders of the days from start to end that hold rows."""
        return [f"{root}/{day.folder}" for key, day in sorted(self.days.items()) if start <= key <= end and day.folder]


def _file(root: str, number: int) -> str:
    return f"{root}/manifests/{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = matching(spark, f"{root}/manifests/[0-9]*.json")
    return sorted(int(path.rpartition("/")[2].removesuffix(".json")) for path in found)


def is_versioned(spark: SparkSession, root: str) -> bool:
    return bool(_numbers(spark, root))


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The newest manifest, or one of a number; an empty one before the first load."""
    if number is None:
        number = max(_numbers(spark, root), default=0)
    if not number:
        return Manifest()
    held = json.loads(read_text(spark, _file(root, number)))
    days = {key: Day(day["folder"], day["source"], tuple(day["covers"])) for key, day in held["days"].items()}
    return Manifest(number, days, held["notes"])


def commit(spark: SparkSession, root: str, change: Callable[[Manifest], Manifest | None]) -> Manifest:
    """Put `change` of the newest manifest in its place; None leaves it. Called again when another
    load was faster, with its manifest."""
    make_folder(spark, f"{root}/manifests")
    while True:
        now = read_manifest(spark, root)
        after = change(now)
        if after is None:
            return now
        after = replace(after, number=now.number + 1)
        held = {"days": {key: asdict(day) for key, day in sorted(after.days.items())}, "notes": after.notes}
        if write_new(spark, _file(root, after.number), json.dumps(held, indent=0)):
            return after


def new_load() -> str:
    """Name of a load's own folder below the root."""
    return f"load={uuid.uuid4().hex}"


def replaced(days: Iterable[str], load: str, empty: Iterable[str] = (), sources: dict[str, str] | None = None) -> dict[str, Day]:
    """Entries of the days a load wrote, and of those it found without rows."""
    sources = sources or {}
    entries = {day: Day(f"{load}/partition={day}", sources.get(day, "")) for day in days}
    return {day: Day("", sources.get(day, "")) for day in empty} | entries


def read_versioned(
    spark: SparkSession, root: str, schema: StructType, start: str = "", end: str = "~", manifest: Manifest | None = None
) -> DataFrame:
    """The days from start to end as of a manifest, the newest by default: its folders and no others
    are listed."""
    folders = (manifest or read_manifest(spark, root)).folders(root, start, end)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(schema.names)


def vacuum(spark: SparkSession, root: str, keep: int = KEEP, grace_seconds: float = GRACE_SECONDS) -> int:
    """Delete all manifests but the newest `keep`, and loads that none of these names and that are
    older than `grace_seconds`: a load may still be running. Gives the number of loads deleted."""
    numbers = _numbers(spark, root)
    kept = numbers[-keep:]
    named = {day.folder.partition("/")[0] for number in kept for day in read_manifest(spark, root, number).days.values()}
    for number in numbers[: -len(kept)] if kept else []:
        delete_folder(spark, _file(root, number))
    before = (time.time() - grace_seconds) * 1000
    old = [f.path for f in file_states(spark, f"{root}/load=*") if f.path.rpartition("/")[2] not in named and f.modified <= before]
    for path in old:
        delete_folder(spark, path)
    return len(old)
