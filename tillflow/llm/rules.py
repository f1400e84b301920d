"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Fixed base rules, then cutoffs on four statistics, a set of them per stratum (language). A quarter of
the labelled good documents, by a hash of the id, proposes: the cutoffs of a level are quantiles of its
statistics, and before them, as a quarter's largest value is soon exceeded, multiples of the largest; levels
go from the laxest to the strictest. The other three quarters test: a level falsely rejects
what lies above any of its cutoffs, and its p-value is the exact binomial tail
P(X <= false rejections | n, RISK). Levels of a stratum are tested in their fixed order and the first that
fails ends it, which costs no correction; strata are corrected by Holm, where one whose levels all
pass hands its share of DELTA on. So with confidence 1 - DELTA the strictest certified level
of every stratum rejects at most RISK of its good documents. A stratum with too few labels has no certified
level (without a false rejection it takes log(DELTA / strata) / log(1 - RISK) of them), and there the
method rejects nothing.

Statistics are counted in thousandths, rounded up and capped at CAP, so that quantiles come out of a
histogram of bounded length and are exact.

Defined results: NULL text has no words and fails the base rules; NULL lang is a stratum of its own;
labels given twice count as good only if all agree; repeated rows are kept; empty tables give empty
tables; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import NOT_SPACE, staged

RISK = 0.02
DELTA = 0.05
WINDOW = 8
RULES = ("symbols_per_word", "dup_line_share", "repeat_share", "mean_word_chars")
#: The laxest levels: the largest value of the proposing documents times so many thousandths, and a margin.
MULTIPLES = ((4000, 400), (2000, 200), (1500, 100), (1200, 50))
#: Then shares of the proposing documents, in thousandths, that a level's cutoffs do not reject, each by itself.
QUANTILES = (1000, 998, 995, 990, 980)
LEVELS = len(MULTIPLES) + len(QUANTILES)
CAP = 100_000
SEED = "rules-1"


def _bind(value: Column, use) -> Column:
    """use(value) with the value computed once, also inside other lambdas."""
    return F.transform(F.array(value), use)[0]


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; sorting finds them in n log n."""
    same = lambda a, b: F.coalesce(a["hash"] == b["hash"], F.lit(False))
    placed = F.sort_array(F.transform(windows, lambda hash, i: F.struct(hash.alias("hash"), i.alias("at"))))

    def positions(order: Column) -> Column:
        twice = F.filter(order, lambda x, i: same(x, F.get(order, i - 1)) | same(x, F.get(order, i + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("words"))

    def step(state: Column, at: Column) -> Column:
        new = at + WINDOW - F.greatest(state["until"], at)
        return F.struct((at + WINDOW).alias("until"), (state["words"] + new).cast("long").alias("words"))

    return F.aggregate(_bind(placed, positions), start, step)["words"]


def repeat_words(words: Column) -> Column:
    """Number of words in 8-word windows found twice or more in the same text.

    Window hashes are built by doubling: words, pairs, fours, eights.
    """

    def paired(hashes: Column, apart: int) -> Column:
        return _bind(hashes, lambda h: F.zip_with(h, F.slice(h, apart + 1, F.size(h) + 1), lambda a, b: F.xxhash64(a, b)))

    eights = paired(paired(paired(F.transform(words, lambda word: F.xxhash64(word)), 1), 2), 4)
    windows = F.slice(eights, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    count = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _repeated(w)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(words) > WINDOW, _bind(windows, count)).otherwise(F.lit(0).cast("long"))


def text_statistics(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_SPACE))
    split = documents.select(
        F.col("doc_id").alias("rule_doc_id"),
        F.coalesce("lang", F.lit("")).alias("stratum"),
        F.regexp_extract_all(text, F.lit(NOT_SPACE + "+"), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("unlike"))).alias("lines"),
    )
    return split.select(
        F.col("rule_doc_id").alias("doc_id"),
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, word: n + F.char_length(word)).alias("word_chars"),
        "n_symbols",
        (F.col("lines.n") - F.col("lines.unlike")).alias("n_dup_lines"),
        F.col("lines.n").alias("n_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
    )


def statistics() -> dict[str, Column]:
    per_word = lambda name: F.col(name) / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": per_word("n_symbols"),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": per_word("n_repeat_words"),
        "mean_word_chars": per_word("word_chars"),
    }


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(X <= k) for X binomial (n, risk), summed term by term; 1 where k is above the mean, where
    the tail is never small. Terms too small for a double add less than 1e-300 in all."""
    odds = F.log(F.lit(risk / (1 - risk)))
    first = n * F.log(F.lit(1 - risk))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (state["total"] + F.exp(term)).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(terms, F.struct(first.alias("term"), F.exp(first).alias("total")), step)["total"]
    return F.when(k > n * risk, F.lit(1.0)).otherwise(total)


def binned() -> dict[str, Column]:
    """The statistics in thousandths, rounded up: whole numbers, CAP at most."""
    return {name: F.least(F.ceil(value * 1000), F.lit(CAP)).cast("long") for name, value in statistics().items()}


def proposed(good: DataFrame) -> DataFrame:
    """Per stratum of binned statistics: an array of levels per rule, a cutoff each."""
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("bin")) for name in RULES]))
    counts = good.select("stratum", each).groupBy("stratum", "rule", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("stratum", "rule")  # CAP rows at most
    counts = counts.withColumn("up_to", F.sum("n").over(whole.orderBy("bin"))).withColumn("all", F.sum("n").over(whole))
    cuts = [F.floor(F.max("bin") * times / 1000) + margin for times, margin in MULTIPLES]
    cuts += [F.min(F.when(F.col("up_to") * 1000 >= F.col("all") * share, F.col("bin"))) for share in QUANTILES]
    per_rule = counts.groupBy("stratum", "rule").agg(F.array(*cuts).alias("cuts"))
    return per_rule.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == name, F.col("cuts"))).alias(f"cuts_{name}") for name in RULES])


def _above(level: int | Column) -> Column:
    """Whether a document lies above any cutoff of a level (from 0)."""
    above = [F.col(name) > F.get(F.col(f"cuts_{name}"), F.lit(level) if isinstance(level, int) else level) for name in RULES]
    return above[0] | above[1] | above[2] | above[3]


def certify(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per stratum of binned statistics (with doc_id and quality): stratum, n_good and rejected (tested
    documents, and how many of them each level rejects), tails, alpha, levels (how many are certified),
    and cuts_<rule>, the cutoffs of the strictest certified level, NULL without one."""
    good = labelled.where(F.col("quality") == 1)
    proposing = F.substring(F.md5(F.concat(F.lit(SEED + "|"), F.col("doc_id").cast("string"))), 1, 1).isin(*"0123")
    cuts = proposed(good.where(proposing))
    tested = good.where(~proposing).join(cuts, "stratum")
    rejected = [F.sum(_above(level).cast("long")) for level in range(LEVELS)]
    names = [f"cuts_{name}" for name in RULES]
    counts = tested.groupBy("stratum", *names).agg(F.count(F.lit(1)).alias("n_good"), F.array(*rejected).alias("rejected"))
    tails = F.array(*[binomial_tail(F.col("rejected")[level], F.col("n_good"), risk) for level in range(LEVELS)])
    # Holm: strata by the least share of delta that certifies them whole. One row a stratum.
    everything, ranked = Window.partitionBy(), Window.orderBy(F.array_max("tails"), "stratum")
    tests = counts.withColumn("tails", tails).withColumn("rank", F.row_number().over(ranked)).withColumn("strata", F.count(F.lit(1)).over(everything))
    fails = F.array_max("tails") > F.lit(delta) / (F.col("strata") - F.col("rank") + 1)
    whole = F.coalesce(F.min(F.when(fails, F.col("rank"))).over(everything) - 1, F.col("strata"))
    alpha = F.lit(delta) / F.greatest(F.col("strata") - whole, F.lit(1))
    first_failed = F.array_position(F.transform("tails", lambda tail: tail > F.col("alpha")), F.lit(True))
    levels = F.when(first_failed == 0, F.lit(LEVELS)).otherwise(first_failed - 1).cast("int")
    at = [F.get(F.col(name), F.col("levels") - 1).alias(name) for name in names]
    return tests.withColumn("alpha", alpha).withColumn("levels", levels).select("stratum", "n_good", "rejected", "tails", "alpha", "levels", *at)


def judge(documents: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, stratum."""
    measured = staged(text_statistics(documents)).withColumns(binned())
    agreed = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    limits = staged(certify(measured.join(agreed, "doc_id"), risk, delta))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    above = [F.coalesce(F.col(name) > F.col(f"cuts_{name}"), F.lit(False)) for name in RULES]
    rejected = above[0] | above[1] | above[2] | above[3]
    return measured.join(limits.select("stratum", *[f"cuts_{name}" for name in RULES]), "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & ~rejected).alias("kept"),
        "stratum",
    )
