"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.files import delete_folder
from tillflow.session import work_folder

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(names: list[str]) -> list[Column]:
    """Columns by their whole names: a dot in one is no path."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


# Folders written within the open scratch() blocks, innermost last.
_WRITTEN: list[dict[int, tuple[DataFrame, str]]] = []


def staged(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back: later steps start from the files,
    so a lost executor costs no recomputation of what came before."""
    folder = work_folder(frame.sparkSession)
    frame.write.parquet(folder)
    back = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    if _WRITTEN:
        _WRITTEN[-1][id(back)] = back, folder
    return back


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what staged() writes within the block at its end, but for frames passed to the function
    given. What the block returns must not be read from anything else written in it."""
    written: dict[int, tuple[DataFrame, str]] = {}
    _WRITTEN.append(written)

    def keep(frame: DataFrame) -> DataFrame:
        kept = written.pop(id(frame))
        if len(_WRITTEN) > 1:
            _WRITTEN[-2][id(frame)] = kept
        return frame

    try:
        yield keep
    finally:
        _WRITTEN.pop()
        for _, folder in written.values():
            delete_folder(spark, folder)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, also inside other lambdas."""
    return F.transform(F.array(value), use)[0]


#: Values that a running result is carried over one by one; beyond, whole chunks are carried.
CHUNK = 256


def before_each(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each value of an array what `combine` makes of those before it, from `zero` on. An array
    grows by copying, so it is built in chunks: near-linear where one array would be quadratic."""

    def running(some: Column, first: Column) -> Column:
        none = F.array().cast("array<bigint>")
        step = lambda state, x: F.struct(combine(state["now"], x).alias("now"), F.concat(state["out"], F.array(state["now"])).alias("out"))
        return F.aggregate(some, F.struct(first.alias("now"), none.alias("out")), step)["out"]

    def chunked(every: Column) -> Column:
        last = F.greatest(F.floor((F.size(every) - 1) / CHUNK), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(every, n * CHUNK + 1, CHUNK))

    def joined(chunks: Column) -> Column:
        firsts = running(F.transform(chunks, lambda some: F.aggregate(some, zero, combine)), zero)
        return F.flatten(F.zip_with(chunks, firsts, running))

    return bind(values, lambda every: bind(chunked(every), joined))


def n_words(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; NULL has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE + "+")
    ends = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    return F.greatest(F.size(parts).cast("long") - ends, F.lit(0).cast("long"))
