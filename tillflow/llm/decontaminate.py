"""Benchmark decontamination: a positional inverted index, intersected from the rarest terms.

Windows of benchmark items are looked up in the texts. All occurrences of their terms are counted
first, so every window knows its terms from the rarest to the most frequent, and windows with a term
that no text holds are gone. The index then stores postings (term, address of the text, position): those
of the rarest terms, and those within reach of one, as no other posting can be part of a match. If the
benchmark's terms are too many to broadcast, it stores the postings of all of them instead, by a
shuffled join. Lists are intersected with their offsets taken off: the rarest term's postings say
where a window would begin, the second rarest's thin these out, the others' confirm what is left.
A term counts if it lies within `slop` places of where the rarest one puts it.

One pass finds both: a match whose terms all lie where they should is the phrase, one that needs `slop`
is proximity. Texts are known by 128 bits of their SHA-256, so copies of a text share their postings and matches, and rows need
no id. Nothing but DataFrame functions touches a text, and no text is shuffled.

Defined results: NULL and empty texts have no words and no hits; repeated rows and NULL ids give a row
each; items without words have no windows; a NULL item_id reads as an empty one, and rows with one
item_id are one item; other columns are ignored, whatever their names; empty tables give no rows, or
rows without hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import scratch, staged

WORDS = 10
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Places that the terms of a proximity match may be off.
SLOP = 2
#: Tables of the benchmark's terms and windows are broadcast up to this size, and shuffled beyond it.
BROADCAST_BYTES = 32 << 20


def _split(text: Column) -> Column:
    """Words of a text, with an empty one before or after them if the text begins or ends with others."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(low, APART)


def _address(text: Column) -> Column:
    """128 bits of a text's SHA-256, as 32 digits."""
    return F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256), 1, 32)


def _hinted(frame: DataFrame, size: Column, most: int) -> tuple[DataFrame, bool]:
    """The frame marked for broadcast if its rows, `size` bytes each, take `most` at most."""
    total = frame.agg(F.sum(size + 32)).first()[0] or 0
    return (F.broadcast(frame), True) if total <= most else (frame, False)


def windows(items: DataFrame, words: int = WORDS) -> DataFrame:
    """item, terms: the windows of `words` words of every item, or all its words if it has fewer."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.filter(_split(F.col("text")), lambda w: w != "").alias("w"))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - words + 1, F.lit(1)))).alias("at")
    return split.where(F.size("w") > 0).select("item", "w", at).select("item", F.slice("w", F.col("at"), words).alias("terms")).distinct()


def term_counts(documents: DataFrame, terms: DataFrame, fits: bool) -> DataFrame:
    """term, n: occurrences of the given terms in all texts."""
    found = documents.select(F.explode(_split(F.col("text"))).alias("term"))
    if fits:
        return found.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(terms, "term", "left_semi")


def plan(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """phrase, size, lists: each window's (n, offset, term) from the rarest term on, for windows whose
    terms all occur."""
    each = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    ranked = each.join(counts, "term").groupBy("phrase", "size").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("lists"))
    return ranked.where(F.size("lists") == F.col("size"))


def index(documents: DataFrame, terms: DataFrame, leads: DataFrame, fits: bool, reach: int) -> DataFrame:
    """The postings: term, address, pos, and whether the posting itself was looked for. A posting within
    reach of several is there several times. `leads` are the rarest terms."""
    # The address goes before the words, so that both are made once a text; words count from 1.
    listed = documents.select(F.concat(F.array(_address(F.col("text"))), _split(F.col("text"))).alias("w"))
    words = listed.select("w", F.posexplode("w").alias("pos", "term")).where("pos > 0")
    address = F.unhex(F.expr("w[0]")).alias("address")
    if not fits:
        leads = leads.withColumn("lead", F.lit(True))
        return words.select("term", address, "pos").join(terms, "term", "left_semi").join(leads, "term", "left").withColumn("lead", F.coalesce("lead", F.lit(False)))
    around = F.explode(F.sequence(F.greatest(F.col("pos") - reach, F.lit(1)), F.least(F.col("pos") + reach, F.size("w") - 1))).alias("at")
    near = words.join(leads, "term", "left_semi").select("w", "pos", around)
    return near.select(F.expr("w[at]").alias("term"), address, F.col("at").alias("pos"), (F.col("at") == F.col("pos")).alias("lead")).join(terms, "term", "left_semi")


def _confirmed(open_: DataFrame, plans: DataFrame, postings: DataFrame, first: int, count: int, slop: int) -> DataFrame:
    """The open matches (id, address, start, exact) whose lists first, first + 1, … hold their terms;
    `exact` stays true where all of them do so in their places."""
    lists = F.slice("lists", first + 1, count)
    asked = plans.select("id", F.size(lists).alias("wanted"), F.explode_outer(lists).alias("l"))
    rows = open_.join(asked, "id")
    done = rows.where("wanted = 0").select("id", "address", "start", "exact")
    off = F.explode(F.sequence(F.lit(-slop), F.lit(slop))) if slop else F.lit(0)
    looked = rows.where("wanted > 0").select("id", "address", "start", "exact", "wanted", F.col("l.offset").alias("offset"), F.col("l.term").alias("term"), off.alias("off"))
    looked = looked.withColumn("pos", F.expr("start + offset + off"))
    met = looked.join(postings, ["address", "pos", "term"], "left_semi")
    # First by list, so that what is counted needs no sets.
    by_list = met.groupBy("id", "address", "start", "exact", "wanted", "offset").agg(F.max((F.col("off") == 0).cast("int")).alias("placed"))
    kept = by_list.groupBy("id", "address", "start", "exact", "wanted").agg(F.count(F.lit(1)).alias("met"), F.sum("placed").alias("placed")).where("met = wanted")
    return kept.select("id", "address", "start", (F.col("exact") & (F.col("placed") == F.col("wanted"))).alias("exact")).unionByName(done)


def matches(plans: DataFrame, postings: DataFrame, slop: int = SLOP, most: int = BROADCAST_BYTES) -> DataFrame:
    """id, address, start, exact: where the windows of `plans` (id, size, lists) occur, with every term within
    `slop` places of its own; exact: as a phrase."""
    plans, _ = _hinted(plans, F.col("size") * 40, most)
    rarest = plans.select("id", F.expr("lists[0].term").alias("term"), F.expr("lists[0].offset").alias("offset"))
    open_ = postings.where("lead").join(rarest, "term").select("id", "address", (F.col("pos") - F.col("offset")).alias("start"))
    open_ = open_.where(F.col("start") >= 1 - slop).distinct().withColumn("exact", F.lit(True))
    seconds = plans.select(F.expr("lists[1].term").alias("term")).distinct()
    thinned = staged(_confirmed(open_, plans, postings.join(seconds, "term", "left_semi"), 1, 1, slop))
    return _confirmed(thinned, plans, postings, 2, 1000, slop)


def decontaminate(
    documents: DataFrame, items: DataFrame, words: int = WORDS, slop: int = SLOP, most: int = BROADCAST_BYTES
) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items
    (items with a window whose terms all lie within `slop` places of their own)."""
    with scratch(documents.sparkSession) as keep:
        held = staged(windows(items, words).withColumn("phrase", F.array_join("terms", " ")))
        phrases = held.select("phrase", "terms").dropDuplicates(["phrase"])
        terms, fits = _hinted(staged(phrases.select(F.explode("terms").alias("term")).distinct()), F.length("term") * 2, most)
        counts = staged(term_counts(documents, terms, fits))
        plans = staged(plan(phrases, counts).withColumn("id", F.monotonically_increasing_id()))
        leads = plans.select(F.expr("lists[0].term").alias("term")).distinct()
        leads = F.broadcast(leads) if fits else leads
        postings = staged(index(documents, terms, leads, fits, words - 1 + slop))
        met = staged(matches(plans, postings, slop, most))
        exact = met.where("exact").join(plans.select("id", "size"), "id")

        places = exact.select("address", "start", (F.col("start") + F.col("size")).alias("stop")).distinct()
        before = Window.partitionBy("address").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
        fresh = F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.col("start")))
        hit = places.select("address", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("address").agg(F.sum("fresh").cast("long").alias("n_hit"))
        owners = held.join(plans.select("phrase", "id"), "phrase").select("id", "item")
        of_text = met.join(owners, "id").groupBy("address", "item").agg(F.max(F.col("exact").cast("int")).alias("exact"))
        # A text's items are at most those of the benchmark.
        found = of_text.groupBy("address").agg(
            F.sort_array(F.collect_set(F.when(F.col("exact") == 1, F.col("item")))).alias("found"), F.count(F.lit(1)).alias("n_near_items")
        )
        per_text = staged(found.join(hit, "address", "left"))

        split = _split(F.col("text"))
        ends = (F.col("w")[0] == "").cast("long") + (F.element_at("w", -1) == "").cast("long")
        rows = documents.select("doc_id", F.unhex(_address(F.col("text"))).alias("address"), split.alias("w"))
        rows = rows.select("doc_id", "address", F.greatest(F.size("w") - ends, F.lit(0)).cast("long").alias("n_words"))
        joined = rows.join(per_text, "address", "left")
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
        none = F.array().cast("array<string>")
        result = joined.select(
            "doc_id", "n_words", n_hit.alias("n_hit"), F.size(F.coalesce("found", none)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("found", none), ",").cast("binary"), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"), F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        )
        return keep(staged(result))
