"""Phrase collocation mining: Rabin-Karp fingerprints, counted in a shuffle, verified against text.

A pass over the texts per phrase length hashes every run of that many words: prefix polynomials
over the bytes give the words, prefix polynomials over the words give the runs, a few array
operations each. The shuffle sums fingerprints, never texts. The fingerprints that reach `least`
set bits in a table of fixed size, which is all that the driver and the next pass see: a run of n + 1
words goes on only if both its runs of n words may be frequent. The table has no false negatives, so
a full one costs traffic and never a phrase.

The last pass materialises: the occurrences of a fingerprint are compared byte by byte with the one
its pointer names, those that differ become phrases of their own, and the shuffle sums counts by
the text with the least pointer to a document. So a collision of fingerprints can add a candidate and
never a count. All later steps are joins of frequent phrases.

Defined results: NULL and empty texts have no words; a NULL lang is `und` and shares its counts with
that name; rows count as often as they are there; NULL ids give no pointer; texts are cut into slices
only at breakers, so that a very long text needs no large arrays; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import scratch, staged
from tillflow.llm.words import _BYTE, _LOWER, _powers, buffers, mix
from tillflow.session import session_conf

LEAST = 30
LONGEST = 4
PER_LANG = 2000
#: Candidates go if this share of theirs lies in one longer candidate.
INSIDE_PERCENT = 80
SCALE = 2_000_000

#: The table of a length has 2**TABLE_BITS numbers of 64 bits: 8 MB, whatever the corpus.
TABLE_BITS = 20
#: Bytes of text that one round of array operations takes, and fingerprints summed before they leave.
SLICE_BYTES = 1 << 20
HELD = 1 << 21
#: Whole texts that a Python worker takes at a time.
ARROW_ROWS = 1000

_BREAKER = np.zeros(256, dtype=bool)
_BREAKER[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAKER.copy()
_APART[[0x20, 0x09]] = True


@dataclass
class Run:
    """Words of a slice: `text` holds them with one space after each, at start to stop; `tied[i]`
    says that word i + 1 follows word i within a piece; prints are their fingerprints."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    doc: np.ndarray
    tied: np.ndarray
    prints: np.ndarray
    sums: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all runs of n words within pieces, and the fingerprints of the runs."""
        if n == 1:
            return np.arange(len(self.prints)), self.prints
        whole = np.ones(max(len(self.prints) - n + 1, 0), bool)
        for k in range(n - 1):
            whole &= self.tied[k : k + len(whole)]
        at = np.flatnonzero(whole)
        down = _powers("down", len(self.sums))
        return at, mix((self.sums[at + n] - self.sums[at]) * down[at] + np.uint64(n))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of SLICE_BYTES at most that end where a text or a piece ends; a longer piece is a
    range of its own."""
    ends = np.union1d(offsets[1:], np.flatnonzero(_BREAKER[data]))
    begin = 0
    while begin < len(data):
        last = np.searchsorted(ends, begin + SLICE_BYTES, side="right") - 1
        end = int(ends[max(last, np.searchsorted(ends, begin, side="right"))])
        yield begin, end
        begin = end


def runs(texts: pa.Array, salt: np.ndarray) -> Iterator[Run]:
    """Words of whole texts, slice by slice; `salt` sets the fingerprints of each text's language apart."""
    data, offsets = buffers(texts)
    data = _LOWER[data]
    for begin, end in _cuts(data, offsets):
        part = data[begin:end]
        apart = _APART[part]
        solid = np.zeros(len(part) + 2, np.int8)
        solid[1:-1] = ~apart
        edge = np.diff(solid)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Where a text ends without a space, the next one's first word is a word of its own.
        inner = np.unique(offsets[(offsets > begin) & (offsets < end)]) - begin
        glued = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]
        if len(glued):
            start, stop = np.sort(np.append(start, glued)), np.sort(np.append(stop, glued))
        doc = np.searchsorted(offsets, start + begin, side="right") - 1
        breaks = np.zeros(len(part) + 1, np.int64)
        np.cumsum(_BREAKER[part], out=breaks[1:])
        tied = (breaks[start[1:]] == breaks[stop[:-1]]) & (doc[1:] == doc[:-1])
        length = stop - start
        text = np.full(len(start) + int(length.sum()), 0x20, np.uint8)
        place = np.repeat(np.arange(len(start)), length)
        text[np.arange(len(place)) + place] = part[~apart]
        first = np.cumsum(length + 1) - length - 1
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_BYTE[text] * _powers("up", len(text) + 1)[: len(text)], out=sums[1:], dtype=np.uint64)
        raw = (sums[first + length] - sums[first]) * _powers("down", len(text) + 1)[first]
        prints = mix((raw + length.astype(np.uint64)) ^ salt[doc])
        over = np.zeros(len(prints) + 1, np.uint64)
        np.cumsum(prints * _powers("up", len(prints) + 1)[: len(prints)], out=over[1:], dtype=np.uint64)
        yield Run(text, first, first + length, doc, tied, prints, over)


def _salt(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    each = [int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest()) for lang in coded.dictionary.to_pylist()]
    return np.array(each, np.uint64)[coded.indices.to_numpy()] if len(langs) else np.zeros(0, np.uint64)


def may_be_in(table: np.ndarray, prints: np.ndarray, buckets: int) -> np.ndarray:
    """Whether all three bits of each fingerprint are set; true for all that the table was made of."""
    one, low = np.uint64(1), np.uint64(63)
    third = (prints >> np.uint64(32)) % np.uint64(buckets) & low
    bits = one << (prints >> np.uint64(20) & low) | one << (prints >> np.uint64(26) & low) | one << third
    return table[(prints & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)] & bits == bits


def _open_grams(run: Run, n: int, tables: dict[int, np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of n words whose shorter runs, and themselves if their table is there, may be frequent."""
    at, prints = run.grams(n)
    if n > 1 and n not in tables and len(at):
        shorter_at, shorter = run.grams(n - 1)
        good = np.zeros(len(run.prints) + 1, bool)
        good[shorter_at[may_be_in(tables[n - 1], shorter, buckets)]] = True
        kept = good[at] & good[at + 1]
    elif n in tables:
        kept = may_be_in(tables[n], prints, buckets)
    else:
        return at, prints
    return at[kept], prints[kept]


def _packed(prints: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Summed fingerprints by bucket, one row for those seen once and one, with counts, for the others:
    four bytes a fingerprint where a row of its own takes three times as many."""
    every = np.concatenate(prints)
    every = (every >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | every & np.uint64(0xFFFFFFFF)
    each, n = np.unique(every, return_counts=True)
    for rows in (n == 1, n > 1):
        some, counts = each[rows], n[rows]
        if not len(some):
            continue
        bucket = (some >> np.uint64(32)).astype(np.int32)
        heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        cuts = pa.array(np.append(heads, len(some)).astype(np.int32))
        low = pa.ListArray.from_arrays(cuts, pa.array(some.astype(np.uint32).view(np.int32)))
        many = pa.nulls(len(heads), pa.list_(pa.int32())) if counts[0] == 1 else pa.ListArray.from_arrays(cuts, pa.array(counts.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(bucket[heads]), low, many], ["bucket", "prints", "counts"])


def frequent_table(texts: DataFrame, n: int, tables: dict[int, np.ndarray], least: int, buckets: int) -> np.ndarray:
    """The bits of the fingerprints of runs of n words that occur `least` times or more."""
    shared = texts.sparkSession.sparkContext.broadcast(tables)  # 8 MB a length

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for run in runs(batch["text"], _salt(batch["lang"])):
                _, prints = _open_grams(run, n, shared.value, buckets)
                held.append(prints)
                size += len(prints)
                if size >= HELD:
                    yield from _packed(held, buckets)
                    held, size = [], 0
        if size:
            yield from _packed(held, buckets)

    packed = texts.mapInArrow(count, "bucket int, prints array<int>, counts array<int>").repartition("bucket")
    seen = packed.select("bucket", "counts", F.posexplode("prints").alias("at", "print"))
    seen = seen.select("bucket", "print", F.coalesce(F.expr("counts[at]"), F.lit(1)).cast("long").alias("n"))
    frequent = seen.groupBy("bucket", "print").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bit = "shiftleft(1L, shiftrightunsigned(print, 20) & 63) | shiftleft(1L, shiftrightunsigned(print, 26)) | shiftleft(1L, bucket & 63)"
    place = F.col("print").bitwiseAND((1 << TABLE_BITS) - 1)
    rows = frequent.groupBy(place.alias("place")).agg(F.bit_or(F.expr(bit)).alias("bits")).toArrow()
    shared.unpersist()
    table = np.zeros(1 << TABLE_BITS, np.uint64)  # the rows are its numbers that are not 0
    table[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return table


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, … for each length on end."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) - np.repeat(before - start, length)


def _materialised(run: Run, n: int, at: np.ndarray, prints: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts of the runs of n words at `at`, their counts, and the pointers to one occurrence of each."""
    order = np.argsort(prints, kind="stable")
    at, prints = at[order], prints[order]
    new = np.ones(len(at), bool)
    new[1:] = prints[1:] != prints[:-1]
    group = np.cumsum(new) - 1
    owner = np.flatnonzero(new)[group]
    start, length = run.start[at], run.stop[at + n - 1] - run.start[at]
    differs = length != length[owner]
    alike = np.flatnonzero(~differs)
    mine = run.text[_ragged(start[alike], length[alike])]
    named = run.text[_ragged(start[owner[alike]], length[alike])]
    wrong = np.concatenate([[0], np.cumsum(mine != named)])
    ends = np.cumsum(length[alike])
    differs[alike] = wrong[ends] != wrong[ends - length[alike]]
    kept = np.flatnonzero(new | differs)
    counts = np.bincount(group[~differs], minlength=int(new.sum()))
    per_row = np.ones(len(at), np.int64)
    per_row[new] = counts
    offsets = np.concatenate([[0], np.cumsum(length[kept])]).astype(np.int32)
    text = run.text[_ragged(start[kept], length[kept])]
    texts = pa.StringArray.from_buffers(len(kept), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes()))
    return texts, per_row[kept], at[kept]


FOUND = "lang string, phrase string, words int, n long, pointer long"


def frequent_phrases(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """Per lang: phrase, words, a (its count), first_doc (the least id that holds it) for all phrases of
    1 to `longest` words with a >= `least`; the phrase '' has the count of all words."""
    texts = documents.select(
        F.expr("try_cast(doc_id AS long)").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    # More buckets than partitions, so that these are even; a fingerprint is a bucket and 32 bits.
    buckets = 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables: dict[int, np.ndarray] = {}
    for n in range(1, longest):
        tables[n] = frequent_table(texts.select("lang", "text"), n, {k: t for k, t in tables.items() if k == n - 1}, least, buckets)
    shared = documents.sparkSession.sparkContext.broadcast(tables)

    def materialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids = batch["lang"], batch["id"]
            for run in runs(batch["text"], _salt(langs)):
                if not len(run.doc):
                    continue
                for n in range(1, longest + 1):
                    at, prints = _open_grams(run, n, shared.value, buckets)
                    if not len(at):
                        continue
                    phrases, counts, pointer = _materialised(run, n, at, prints)
                    doc = pa.array(run.doc[pointer])
                    columns = [langs.take(doc), phrases, pa.array(np.full(len(counts), n, np.int32)), pa.array(counts), ids.take(doc)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n", "pointer"])
                doc, counts = np.unique(run.doc, return_counts=True)
                none = pa.nulls(len(doc), pa.int64())
                columns = [langs.take(pa.array(doc)), pa.array([""] * len(doc)), pa.array(np.zeros(len(doc), np.int32)), pa.array(counts.astype(np.int64)), none]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n", "pointer"])

    found = texts.mapInArrow(materialise, FOUND)
    summed = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a"), F.min("pointer").alias("first_doc"))
    return summed.where((F.col("a") >= least) | (F.col("words") == 0))


def _part(begin: Column, length: Column) -> Column:
    return F.array_join(F.slice("parts", begin, length), " ")


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, per_lang: int = PER_LANG) -> DataFrame:
    """Each lang's first `per_lang` collocations: lang, rank, phrase, a, l, r, n, score, first_doc."""
    spark = documents.sparkSession
    with scratch(spark) as keep, session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS}):
        counts = staged(frequent_phrases(documents, least, longest))
        total = counts.where("words = 0").select("lang", F.col("a").alias("n"))
        phrases = counts.where("words > 0")
        candidates = phrases.where("words > 1").withColumn("parts", F.split("phrase", " "))
        cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
        parted = candidates.select("lang", "phrase", "a", "words", "parts", cut).select(
            "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")
        )
        left = phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
        right = phrases.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
        # Both parts of a frequent phrase are frequent, so the inner joins lose nothing.
        exact = F.expr(f"cast({SCALE} as decimal(38,0)) * a div (cast(l as decimal(38,0)) + r)")
        rated = parted.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", exact)
        best = rated.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        # Shorter candidates within each candidate, with its count.
        length = F.explode(F.expr("sequence(2, words - 1)")).alias("length")
        longer = candidates.where("words > 2").select("lang", "a", "words", "parts", length)
        begin = F.explode(F.expr("sequence(1, words - length + 1)")).alias("begin")
        within = longer.select("lang", "a", "parts", "length", begin).select(
            "lang", _part(F.col("begin"), F.col("length")).alias("phrase"), F.col("a").alias("around")
        )
        within = within.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
        judged = candidates.select("lang", "phrase", "a", "first_doc").join(within, ["lang", "phrase"], "left")
        free = F.col("around").isNull() | (F.col("around").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * INSIDE_PERCENT)
        scored = judged.where(free).join(best, ["lang", "phrase"]).select("lang", "phrase", "a", "best.*", "first_doc")
        by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        # Spark keeps the first rows of each task before it brings a lang together.
        first = scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= per_lang)
        ranked = first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"), "first_doc")
        return keep(staged(ranked))
