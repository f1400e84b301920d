"""Folder listings through the file system Spark itself uses. Metadata only, never file content."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileState:
    path: str
    length: int
    modified: int  # milliseconds since 1970


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; none where nothing does."""
    files, path = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def day_folders(spark: SparkSession, root: str, start: str, end: str) -> dict[str, str]:
    """Day folders of a table from start to end: day to path, one listing of the root."""
    folders = matching(spark, f"{root}/partition=*")
    days = {path.rpartition("partition=")[2]: path for path in folders}
    return {day: path for day, path in days.items() if start <= day <= end}


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete many folders, some at a time: a day table has thousands, and each takes a few calls."""
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda folder: delete_folder(spark, folder), folders))


def make_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.mkdirs(path)


def file_states(spark: SparkSession, pattern: str) -> list[FileState]:
    """Path, length and time of everything that matches a glob; none where nothing does."""
    files, path = _file_system(spark, pattern)
    found = files.globStatus(path) or []
    return sorted((FileState(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found), key=lambda f: f.path)


def read_text(spark: SparkSession, file: str) -> str:
    files, path = _file_system(spark, file)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, file: str, text: str) -> bool:
    """Make a small file appear whole under its name, by a rename; False if the name is taken."""
    folder, _, name = file.rpartition("/")
    files, hidden = _file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = files.create(hidden)
    stream.write(text.encode())
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 0)  # none: a file that is there is not replaced
    try:
        context.rename(hidden, jvm.org.apache.hadoop.fs.Path(file), options)
    except Exception:
        files.delete(hidden, False)
        if matching(spark, file):
            return False
        raise
    return True
