"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The words of a source stand end to end, its documents in a seeded order, and are cut into blocks of
`block_words`. All blocks of the mix are apportioned to the sources by highest quotients
target / (2k + 1), once for each number of shards filled so far: the method is house monotone, so the
differences are the integer quotas of each shard. The words of a source's quota are whole passes over
the source, and of one more pass as many blocks as come nearest to the rest, evenly spread from a
seeded offset. Laid end to end they fill the shards by the source's quotas, shard 0 first: `shard_words`
says how many words of a document go to each shard. The last shard takes what rounding leaves.

Defined results: NULL text has size 0 and takes nothing; NULL source is a source of its own, last in
order; NULL or repeated doc_id are rows like all others (rows without an id are ordered by their text,
equal rows arbitrarily);
an empty table gives no rows; other columns are ignored unless named in `carry`.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import NOT_SPACE, SPACE, n_words, quoted, staged

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 32
SHARDS = 16
SEED = "mix-1"
#: Documents of a source are ordered within 16**3 buckets of their seeded key, so that a source with
#: a third of all rows is summed in thousands of pieces.
BUCKET_DIGITS = 3

_QUOTAS = "mix_key string, n_blocks long, quota long, shard_quotas array<long>"


def apportion(targets: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë: the `seats` highest quotients target / (2k + 1), k below the source's cap; ties
    go to the earlier source. Most seats are given at once by a divisor that gives too few."""
    targets = np.asarray(targets, float)
    caps = np.where(targets > 0, np.asarray(caps, np.int64), 0)
    seats = min(int(seats), int(caps.sum()))

    def given(divisor: float) -> np.ndarray:
        # Quotients of at least 2 * divisor: (2k + 1) * 2 * divisor <= target.
        return np.minimum(caps, np.floor(targets / (2 * divisor) / 2 + 0.5).astype(np.int64))

    low, high = 0.0, float(targets.max(initial=0.0)) + 1.0
    for _ in range(200):  # low: too many seats or just enough; high: too few
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if given(middle).sum() >= seats else (low, middle)
    quotas = given(high)
    # Rounding may leave a seat more than quotients allow: give back two and award them anew.
    quotas = np.maximum(quotas - 2, 0)
    heap = [(-t / (2 * q + 1), i) for i, (t, q, c) in enumerate(zip(targets, quotas, caps)) if q < c]
    heapq.heapify(heap)
    for _ in range(seats - int(quotas.sum())):
        _, i = heapq.heappop(heap)
        quotas[i] += 1
        if quotas[i] < caps[i]:
            heapq.heappush(heap, (-targets[i] / (2 * quotas[i] + 1), i))
    return quotas


def _keyed(documents: DataFrame, seed: str, carry: list[str]) -> DataFrame:
    # Rows without an id are spread by their texts: one bucket would hold them all.
    of_text = F.concat(F.lit("#"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return documents.select(
        F.col("doc_id").alias("mix_doc_id"),
        F.col("source").alias("mix_source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("mix_key"),
        n_words(F.col("text")).alias("mix_size"),
        F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), of_text))).alias("mix_order"),
        *[column.alias(f"carry_{name}") for name, column in zip(carry, quoted(carry))],
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: mix_key, mix_source, source_size, weight, target.

    Targets are least(most * size, level * weight): the level at which they add up to all sizes is
    that of the first source, by most * size / weight, that stays below its cap.
    """
    per_source = sizes.groupBy("mix_key", "mix_source").agg(F.sum("mix_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = per_source.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("mix_key"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = ranked.select(
        "*",
        F.row_number().over(by_cap).alias("rank"),
        ((total - capped).cast("double") / F.sum("weight").over(onward).cast("double")).alias("level_here"),
    )
    holds = F.col("level_here") * F.col("weight") <= F.col("cap")
    level = F.min_by("level_here", F.when(holds, F.col("rank"))).over(everything)
    return levels.select(
        "mix_key", "mix_source", "source_size", "weight",
        F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"),
    )


def block_quotas(sources: DataFrame, block_words: int, shards: int, most: int) -> DataFrame:
    """Blocks of each source, its quota of the mix, and that quota shard by shard. One row per source
    goes through one task: rows of sources, not of documents."""

    def award(_key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(last=rows["mix_source"].isna()).sort_values(["last", "mix_key"], kind="stable")
        sizes = rows["source_size"].to_numpy(np.int64)
        blocks = -(-sizes // block_words)
        total = int(round(int(sizes.sum()) / block_words))
        houses = [total * (shard + 1) // shards for shard in range(shards)]
        filled = [apportion(rows["target"].to_numpy(), most * blocks, house) for house in houses]
        each = np.diff(np.array([np.zeros(len(rows), np.int64), *filled]), axis=0)
        return pd.DataFrame(
            {"mix_key": rows["mix_key"], "n_blocks": blocks, "quota": filled[-1], "shard_quotas": list(each.T)}
        )

    columns = sources.select("mix_key", "mix_source", "source_size", "target", F.lit(0).alias("mix"))
    return columns.groupBy("mix").applyInPandas(award, _QUOTAS)


def _whole(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def _chosen_before(block: Column) -> Column:
    """How many blocks of the last, partial pass lie before the given one."""
    shifted = lambda k: F.floor(_whole(k + F.col("offset")) * _whole(F.col("rest")) / _whole(F.col("n_blocks")))
    return (shifted(block) - shifted(F.lit(0))).cast("long")


def place_documents(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: str = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document with its place in its source's words and what the mix takes of it:
    doc_id, source, size, source_size, target, taken, passes, begin, n_blocks, rest, offset, bounds
    (where each shard begins in the source's taken words), and the columns in `carry` (as
    carry_<name>)."""
    keyed = _keyed(documents, seed, carry or [])
    narrow = staged(keyed.select("mix_key", "mix_source", "mix_size", F.substring("mix_order", 1, BUCKET_DIGITS).alias("bucket"))
                    .groupBy("mix_key", "mix_source", "bucket").agg(F.sum("mix_size").alias("mix_size")))
    sources = staged(source_targets(narrow, weights, most))
    quotas = block_quotas(sources, block_words, shards, most)
    sources = staged(sources.join(quotas, "mix_key"))
    ahead = Window.partitionBy("mix_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.select("mix_key", "bucket", F.coalesce(F.sum("mix_size").over(ahead), F.lit(0)).alias("start"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "#"), F.col("mix_key"))), 1, 8), 16, 10).cast("long")
    before = lambda shard: F.aggregate(F.slice("shard_quotas", 1, shard), F.lit(0).cast("long"), lambda n, x: n + x) * block_words
    plan = starts.join(sources, "mix_key").select(
        "mix_key", "bucket", "start", "source_size", "target", "n_blocks",
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), before).alias("bounds"),
        F.expr(f"CASE WHEN source_size > 0 THEN least({most}L, quota * {block_words} div source_size) ELSE 0L END").alias("passes"),
        # What whole passes leave of the quota's words, in blocks of one more pass.
        F.expr(f"""CASE WHEN source_size > 0 AND quota * {block_words} div source_size < {most}
                   THEN least(n_blocks, (quota * {block_words} % source_size + {block_words} div 2) div {block_words})
                   ELSE 0L END""").alias("rest"),
        F.expr("CASE WHEN n_blocks > 0 THEN n_blocks ELSE 1L END").alias("divisor"),
        offset.alias("seeded"),
    ).withColumn("offset", F.col("seeded") % F.col("divisor")).drop("seeded", "n_blocks").withColumnRenamed("divisor", "n_blocks")
    within = Window.partitionBy("mix_key", "bucket").orderBy("mix_order", "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        keyed.withColumn("bucket", F.substring("mix_order", 1, BUCKET_DIGITS))
        .withColumn("inside", F.coalesce(F.sum("mix_size").over(within), F.lit(0)))
        .join(plan, ["mix_key", "bucket"])
        .withColumn("begin", F.col("start") + F.col("inside"))
    )
    chosen = [taken_before(x, block_words) for x in (F.col("begin"), F.col("begin") + F.col("mix_size"))]
    taken = F.col("passes") * F.col("mix_size") + chosen[1] - chosen[0]
    return placed.select(
        F.col("mix_doc_id").alias("doc_id"),
        F.col("mix_source").alias("source"),
        F.col("mix_size").alias("size"),
        "source_size", "target", taken.cast("long").alias("taken"), "passes", "begin", "n_blocks", "rest", "offset", "bounds",
        *quoted([f"carry_{name}" for name in carry or []]),
    )


def taken_before(place: Column, block_words: int) -> Column:
    """Words of the partial pass before a place in the source: whole blocks, then part of one."""
    block = F.floor(place / F.lit(block_words)).cast("long")
    inside = place - block * block_words
    here = _chosen_before(block + 1) - _chosen_before(block)
    return _chosen_before(block) * block_words + inside * here


def mix_quotas(documents: DataFrame, **options) -> DataFrame:
    """The mix as planned, one row per document: doc_id, size, source_size, target, taken, source,
    shard_words (its taken words by shard, comma-joined)."""
    placed = place_documents(documents, **options)
    whole = F.transform(
        F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda k: F.struct((k * F.col("source_size") + F.col("begin")).alias("at"), F.col("size").alias("n")),
    )
    block_words = options.get("block_words", BLOCK_WORDS)
    partial_at = F.col("passes") * F.col("source_size") + taken_before(F.col("begin"), block_words)
    partial = F.struct(partial_at.alias("at"), (F.col("taken") - F.col("passes") * F.col("size")).alias("n"))
    pieces = placed.withColumn("pieces", F.concat(whole, F.array(partial)))

    def words_of(begin: Column, shard: Column) -> Column:
        end = F.coalesce(F.get(F.col("bounds"), shard + 1), F.lit(2**62))
        inside = lambda x: F.greatest(F.least(x["at"] + x["n"], end) - F.greatest(x["at"], begin), F.lit(0))
        return F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + inside(x))

    shard_words = F.array_join(F.transform("bounds", words_of).cast("array<string>"), ",")
    return pieces.select("doc_id", "size", "source_size", "target", "taken", "source", shard_words.alias("shard_words"))


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of the input: a row with the whole text for every pass, and one
    with the words of the chosen blocks, where there are any. n_chars, if there, follows the text."""
    names = documents.columns
    block_words = options.get("block_words", BLOCK_WORDS)
    placed = place_documents(documents, carry=names, **options)
    blocks = F.filter(
        F.sequence(F.floor(F.col("begin") / block_words).cast("long"), F.floor((F.col("begin") + F.col("size") - 1) / block_words).cast("long")),
        lambda k: _chosen_before(k + 1) > _chosen_before(k),
    )
    words = F.regexp_extract_all(F.col("carry_text"), F.lit(f"{SPACE}*{NOT_SPACE}+"), F.lit(0))

    def part(k: Column) -> Column:
        first = F.greatest(k * block_words - F.col("begin"), F.lit(0))
        last = F.least((k + 1) * block_words - F.col("begin"), F.col("size"))
        return F.slice(F.col("mix_words"), (first + 1).cast("int"), (last - first).cast("int"))

    partial = F.col("taken") - F.col("passes") * F.col("size")
    copies = F.expr("CASE WHEN taken > passes * size THEN sequence(0L, passes) WHEN passes > 0 THEN sequence(0L, passes - 1) END")
    cut = F.ltrim(F.array_join(F.flatten(F.transform(F.col("mix_blocks"), part)), ""))
    mixed = (
        placed.where(F.col("taken") > 0)
        .withColumn("mix_blocks", F.when(partial > 0, blocks))
        .withColumn("mix_words", F.when(partial > 0, words))
        .withColumn("mix_cut", F.when(partial > 0, cut))
        .withColumn("mix_copy", F.explode(copies))
    )
    text = F.when(F.col("mix_copy") < F.col("passes"), F.col("carry_text")).otherwise(F.col("mix_cut"))
    columns = dict(zip(names, quoted([f"carry_{name}" for name in names]))) | {"text": text}
    if "n_chars" in names:
        columns["n_chars"] = F.char_length(text).cast(documents.schema["n_chars"].dataType)
    return mixed.select(*[columns[name].alias(name) for name in names])
