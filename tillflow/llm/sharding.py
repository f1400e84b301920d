"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups (equal texts) go, largest first, to the least-loaded shard through a heap. The heap runs over
the distinct group sizes, not over the groups: of n groups of one size, the shards that would win
are found at once. All sizes add up to the corpus T, so there are at most sqrt(2 T) distinct ones
(14 million in 100 TB); that histogram is what one task reads.

Defined results: NULL text has no bytes, so size 1, and groups with the empty text; repeated rows
are rows of one group, each with a slot of its own; NULL doc_ids are rows like others; an empty table
gives no rows; a group larger than a fair share makes its shard larger, since it may not be split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import staged

SHARDS = 16
#: Ranks and slots are counted within 16**3 buckets of a digest, so that no size and no shard has
#: to be sorted by one task.
BUCKET_DIGITS = 3


def longest_first(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For (size, number of groups of it), largest size first: the size and its (shard, groups).

    Same result as one heap step per group; ties go to the lower shard.
    """
    loads = [0] * shards
    heap = [(0, shard) for shard in range(shards)]
    for size, n in sizes:
        given: dict[int, int] = {}
        if n > 4 * shards:
            # A shard's k-th group of this size starts at load + k * size: take all starts below the
            # highest level that does not need more than n groups.
            low, high = min(loads), max(loads) + n * size + 1
            while high - low > 1:
                level = (low + high) // 2
                if sum(max(0, -(-(level - load) // size)) for load in loads) <= n:
                    low = level
                else:
                    high = level
            for shard, load in enumerate(loads):
                if count := max(0, -(-(low - load) // size)):
                    given[shard] = count
                    loads[shard] += count * size
            n -= sum(given.values())
            heap = [(load, shard) for shard, load in enumerate(loads)]
            heapq.heapify(heap)
        for _ in range(n):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            loads[shard] += size
            given[shard] = given.get(shard, 0) + 1
        yield size, sorted(given.items())


def _schedule(shards: int):
    def schedule(_key: tuple, sizes: pd.DataFrame) -> pd.DataFrame:
        sizes = sizes.sort_values("group_bytes", ascending=False)
        rows = []
        for size, given in longest_first(zip(sizes["group_bytes"].tolist(), sizes["n"].tolist()), shards):
            ends, at = [], 0
            for shard, count in given:
                at += count
                ends.append({"until": at, "shard": shard})
            rows.append((size, ends))
        return pd.DataFrame(rows, columns=["group_bytes", "ends"])

    return schedule


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, group_bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
        )
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    groups = staged(groups.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS)))
    sizes = groups.groupBy("group_bytes").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    ends = sizes.groupBy("all").applyInPandas(
        _schedule(shards), "group_bytes long, ends array<struct<until: long, shard: int>>"
    )
    of_size = Window.partitionBy("group_bytes").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = groups.groupBy("group_bytes", "bucket").agg(F.count("*").alias("n"))
    before = per_bucket.select("group_bytes", "bucket", F.coalesce(F.sum("n").over(of_size), F.lit(0)).alias("before"))
    in_bucket = Window.partitionBy("group_bytes", "bucket").orderBy("digest")
    ranked = groups.withColumn("nth", F.row_number().over(in_bucket)).join(before, ["group_bytes", "bucket"])
    home = F.filter("ends", lambda end: F.col("before") + F.col("nth") <= end["until"])[0]["shard"]
    placed = ranked.join(ends, "group_bytes").select("digest", "group_bytes", home.alias("shard"))
    placed = staged(rows.join(placed, "digest").withColumn("bucket", F.substring(F.md5(F.concat_ws("|", "doc_id", "digest")), 1, BUCKET_DIGITS)))
    of_shard = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "bucket", F.coalesce(F.sum("n").over(of_shard), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")
    return (
        placed.withColumn("nth", F.row_number().over(order))
        .join(starts, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "group_bytes",
        )
    )
