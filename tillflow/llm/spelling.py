"""Spelling variants: words at one edit, found by dynamic programming over sorted lists.

Two words at one edit agree before it and after it. So words are brought together by a hole: all
that lies outside of it (a head of fixed length, a tail of fixed length, the length of the shorter
word) is the key of a block, and only what lies in the hole has to be compared. Two holes, the halves
of the shorter word, take in every pair. A block of more than `most` words is split: its hole is
halved, with the keys grown by the other half, until it is small or the hole is one place wide, where
the alphabet bounds it. A pair belongs to the hole in which its common prefix ends, so it is found once.

Within a block the middles are a sorted list, as the shuffle's sort leaves it. Every word of the
shorter length scans the list: rows of the edit matrix, three cells wide, are kept for the prefix that
neighbours of the list share, and a row that passes one edit skips all words that share the prefix.
The scans of all words of a slice advance together, one matrix row a step, in array operations.

Defined results: NULL and empty texts have no words; a NULL id reads as an empty one; repeated rows
count again; very long words are words like others (matrix rows are as long as the hole); an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.llm.common import scratch, staged

LETTER = r"[A-Za-zÀ-ÿ]"
LEAST_CHARS = 6
LEAST_COUNT = 5
#: One run in so many loses a code point, by the checksum of its document's id and itself.
LOSSES = 199
#: A variant's form occurs at least so many times as often.
FORM_RATIO = 5
#: Words of a block before it is split, and rows of a slice of whole blocks.
BLOCK_WORDS = 512
SLICE_ROWS = 1 << 16


def counted_words(documents: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, losses: int = LOSSES) -> DataFrame:
    """word, n: the words of at least `least_chars` code points and `least_count` occurrences."""
    # A run shorter than a word can't become one.
    found = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTER}{{{least_chars},}}"), F.lit(0)))
    run = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found.alias("run"))
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = run.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", capital, small)).otherwise(F.col("run")).alias("run"))
    summed = low.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = "cast(h % length(run) as int)"
    lost = F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")
    word = F.when(F.col("h") % losses == 0, lost).otherwise(F.col("run"))
    words = summed.select(word.alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


_KEY = "concat(s, ':', lo, ':', hi, ':', substring(word, 1, lo), ':', substring(word, length(word) - (s - hi) + 1))"


_MIDDLE = "cast((lo + hi) div 2 as int)"
_HALVES = f"array(named_struct('lo', lo, 'hi', {_MIDDLE}), named_struct('lo', {_MIDDLE}, 'hi', hi))"


def _holes(rows: DataFrame) -> DataFrame:
    """Rows (word, n, s, lo, hi) with each half of their hole, and the key of its block."""
    split = rows.select("word", "n", "s", F.explode(F.expr(_HALVES)).alias("hole"))
    return split.select("word", "n", "s", "hole.lo", "hole.hi").withColumn("key", F.expr(_KEY))


def blocks(words: DataFrame, least_chars: int = LEAST_CHARS, most: int = BLOCK_WORDS) -> DataFrame:
    """Rows of all blocks that can hold a pair: key, middle, word, n, width, final."""
    # A word is the shorter or equal one of its pairs, or the longer one.
    lengths = F.expr(f"filter(array(length(word), length(word) - 1), x -> x >= {least_chars})")
    rows = words.select("word", "n", F.explode(lengths).alias("s")).selectExpr("word", "n", "s", "0 AS lo", "s AS hi")
    ready = []
    while True:
        rows = _holes(rows)
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.expr("length(word) = s")).alias("shorter"))
        pairable = sizes.where("size > 1 AND shorter > 0").select("key", "size")
        sized = staged(rows.join(pairable, "key"))
        large = (F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)
        ready.append(sized.where(~large))
        rows = sized.where(large).select("word", "n", "s", "lo", "hi")
        if rows.isEmpty():
            break
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    middle = F.expr("substring(word, lo + 1, length(word) - lo - (s - hi))")
    return every.select("key", middle.alias("middle"), "word", "n", F.expr("hi - lo").alias("width"), F.expr("hi = s").alias("final"))


def _common(chars: np.ndarray, begin: np.ndarray, length: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Length of the prefix each middle shares with the one before it; -1 at the head of a block."""
    shared = np.where(new, -1, 0)
    at, depth = np.flatnonzero(~new), 0
    while len(at):
        at = at[(length[at] > depth) & (length[at - 1] > depth)]
        at = at[chars[begin[at] + depth] == chars[begin[at - 1] + depth]]
        depth += 1
        shared[at] = depth
    return shared


def _next_lesser(shared: np.ndarray) -> np.ndarray:
    """For each place the next one with a lesser value; beyond the end if there is none."""
    following, open_ = np.full(len(shared), len(shared)), []
    for place, value in enumerate(shared.tolist()):
        while open_ and shared[open_[-1]] > value:
            following[open_.pop()] = place
        open_.append(place)
    return following


def one_edit(middles: pa.Array, new: np.ndarray, width: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (shorter, other) of rows at one edit; `new` marks the first row of each block."""
    length = pc.utf8_length(middles).to_numpy().astype(np.int64)
    chars = np.frombuffer("".join(middles.to_pylist()).encode("utf-32-le"), np.uint32)
    begin = np.cumsum(length) - length
    rows = len(length)
    shared = np.append(_common(chars, begin, length, new), -1)
    following = _next_lesser(shared)
    heads = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    query = np.flatnonzero(length == width)  # others are the longer ones
    size = width[query] + 2
    stack = np.cumsum(size) - size
    # Cells of the matrix row of depth d at columns d - 1, d, d + 1; 2 stands for two edits or more.
    cells = np.full((int(size.sum()), 3), 2, np.int8)
    cells[stack] = (2, 0, 1)
    stop = np.append(heads, rows)[block[query] + 1]
    word, depth = heads[block[query]], np.zeros(len(query), np.int64)
    last = len(chars) - 1
    found = [], []
    while len(query):
        char = chars[begin[word] + depth]
        here, wide = begin[query], width[query]
        x, y, z = cells[stack + depth].T
        before = (depth == 0) | (chars[np.maximum(here + depth - 1, 0)] != char)
        at = (depth >= wide) | (chars[np.minimum(here + depth, last)] != char)
        after = (depth + 1 >= wide) | (chars[np.minimum(here + depth + 1, last)] != char)
        one = np.minimum(np.minimum(y + 1, x + before), 2)
        two = np.where(depth + 1 > wide, 2, np.minimum(np.minimum(np.minimum(z, one) + 1, y + at), 2))
        three = np.where(depth + 2 > wide, 2, np.minimum(np.minimum(two + 1, z + after), 2))
        depth = depth + 1
        dead = (one == 2) & (two == 2) & (three == 2)
        alive = np.flatnonzero(~dead)
        # A longer word's last row needs no place: it is one row past the stack.
        kept = alive[depth[alive] < wide[alive] + 2]
        cells[stack[kept] + depth[kept], 0] = one[kept]
        cells[stack[kept] + depth[kept], 1] = two[kept]
        cells[stack[kept] + depth[kept], 2] = three[kept]
        over = ~dead & (depth == length[word])
        longer = length[word] > wide
        hit = over & (np.where(longer, one, two) == 1) & ~(longer & (y == 0) & ~final[query])
        found[0].append(query[hit])
        found[1].append(word[hit])
        moved = np.flatnonzero(dead | over)
        if not len(moved):
            continue
        # A dead row skips the words that share the prefix with it.
        most = np.where(dead, depth - 1, length[word])[moved]
        to = word[moved] + 1
        while len(skipped := np.flatnonzero(shared[to] > most)):
            to[skipped] = following[to[skipped]]
        word[moved] = to
        depth[moved] = np.maximum(shared[to], 0)
        going = word < stop
        if not going.all():
            query, stack, stop, word, depth = query[going], stack[going], stop[going], word[going], depth[going]
    return np.concatenate([*found[0], np.zeros(0, int)]), np.concatenate([*found[1], np.zeros(0, int)])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Directed pairs of the sorted rows of whole blocks."""

    def paired(table: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        column = {name: table[name].combine_chunks() for name in table.column_names}
        middles = column["middle"]
        shorter, other = one_edit(middles, new, column["width"].to_numpy(), column["final"].to_numpy(zero_copy_only=False))
        # Of two words of one length each finds the other; a longer word is found only.
        sizes = pc.utf8_length(middles).to_numpy()
        uneven = sizes[shorter] != sizes[other]
        a = pa.array(np.concatenate([shorter, other[uneven]]))
        b = pa.array(np.concatenate([other, shorter[uneven]]))
        return pa.RecordBatch.from_arrays([column["word"].take(a), column["word"].take(b), column["n"].take(b)], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(part) for part in held) < SLICE_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table["key"].combine_chunks()
        new = np.append(True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))
        cut = int(np.flatnonzero(new)[-1])  # the last block may go on in the next batch
        if cut:
            yield paired(table.slice(0, cut), new[:cut])
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if len(table):
            keys = table["key"].combine_chunks()
            yield paired(table, np.append(True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)))


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS, most: int = BLOCK_WORDS) -> DataFrame:
    """word, near, near_n for every pair of words at one edit, both ways."""
    rows = blocks(words, least_chars, most).repartition("key").sortWithinPartitions("key", "middle")
    return rows.mapInArrow(_near, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root for every word with a form: the end of its chain, by doubling the steps."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        seen = Observation()
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").observe(seen, F.count("further").alias("moved"))
        now = staged(step.select("word", F.coalesce("further", "root").alias("root")))
        if not seen.get.get("moved"):
            return now


def variants(documents: DataFrame, ratio: int = FORM_RATIO, most: int = BLOCK_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    with scratch(documents.sparkSession) as keep:
        words = staged(counted_words(documents))
        near = near_words(words, most=most)
        best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
        nearest = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best).select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
        often = F.col("form_n") >= F.col("n") * ratio
        formed = words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("form")).alias("form"), F.when(often, F.col("form_n")).alias("form_n")
        )
        formed = staged(formed)
        ends = roots(formed.where("form IS NOT NULL"))
        joined = formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return keep(staged(joined))
