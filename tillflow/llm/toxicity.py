"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are hashed words and the first four to seven bytes of words, as shares of a document's
words. Labels say toxic or not; the grades of toxic documents are thirds of the share of words whose
features go with the label in the training sample. One weight vector serves all thresholds:
P(grade <= k) = sigmoid(threshold_k - score), so severity is the expected grade, and a document is
toxic where P(grade >= 1) reaches a half.

How well a feature goes with the label is counted on all labelled documents, and none is left out for
being rare: a feature's column is scaled by its distance from chance, so that the penalty on its weight
grows smoothly as the evidence gets thin. The weights are fitted on a bounded sample: at most SAMPLE
labelled documents of each class, by a hash of the id; what no sampled document holds has weight 0.
Scoring reads every word of every document.

Defined results: NULL, empty and wordless texts have severity 0 and are not toxic; labels that are
NULL or whose document is missing are not learned from; ids labelled twice count as toxic if any label
says so; without labels of both classes nothing is toxic; repeated rows are scored alike; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import quoted, scratch, staged
from tillflow.llm.words import Words, mix, slices, words

SAMPLE = 2500
#: Distinct features of all sampled documents together, eight bytes each on the driver.
ENTRIES = 6_000_000
#: Entries that one round of the fit's array operations takes.
BLOCK_ENTRIES = 1 << 19
#: Labels are broadcast up to this size.
LABEL_BYTES = 32 << 20
BITS = 18
PREFIXES = (4, 5, 6, 7)
GRADES = 4
#: Standard deviations from chance at which a feature is trusted in full, and how fast trust falls below.
FULL_DEVIATION = 5.0
TRUST_POWER = 4
#: Words added to every document's count, so that one word of a very short text is not a large share.
DAMPING = 40
STEPS = 400
DECAY = 2e-4


@dataclass
class Ordinal:
    """weights: by hashed feature; thresholds: increasing, one less than there are grades."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([30.0, 31.0, 32.0]))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def _features(found: Words) -> list[np.ndarray]:
    """A hashed feature of each kind for every word; a prefix as long as the word is the word."""
    kinds = [found.hashes(), *[found.hashes(length) for length in PREFIXES]]
    return [(mix(h + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int32) for kind, h in enumerate(kinds)]


def scores(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted share of each text's words, and its number of words."""
    found = words(texts)
    n = np.diff(found.first)
    per_word = np.zeros(len(found.doc))
    for kind in _features(found):
        per_word += weights[kind]
    return np.bincount(found.doc, per_word, len(n)) / (n + DAMPING), n


def _distinct(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of texts: the first row, the words of each text, and the distinct (row, feature) of the
    slice in order with their counts."""
    for begin, end in slices(texts):
        found = words(texts.slice(begin, end - begin))
        owner = found.doc.astype(np.int64) << BITS
        pairs, counts = np.unique(np.concatenate([owner + kind for kind in _features(found)]), return_counts=True)
        yield begin, np.diff(found.first), pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32), counts.astype(np.int32)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text with their counts."""
    for batch in batches:
        for begin, n, row, ids, counts in _distinct(batch["text"]):
            cuts = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(values)) for values in (ids, counts)]
            columns = [batch["place"].slice(begin, len(n)), batch["label"].slice(begin, len(n)), pa.array(n.astype(np.int32)), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["place", "label", "n", "ids", "counts"])


def _labelled(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and label of every document with a label of 0 or 1; the larger one, if it has both."""
    known = labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(name).alias("label"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of the documents that hold each feature, in all and toxic; feature -1 is every document."""
    every = 1 << BITS
    seen, hits = np.zeros(every + 1), np.zeros(every + 1)
    for batch in batches:
        weight = batch["weight"].to_numpy()
        toxic = weight * (batch["label"].to_numpy() == 1)
        seen[every] += weight.sum()
        hits[every] += toxic.sum()
        for begin, _, row, ids, _ in _distinct(batch["text"]):
            seen[:every] += np.bincount(ids, weight[begin + row], every)
            hits[:every] += np.bincount(ids, toxic[begin + row], every)
    found = np.flatnonzero(seen)
    feature = np.where(found == every, -1, found).astype(np.int32)
    columns = [pa.array(feature), pa.array(seen[found]), pa.array(hits[found])]
    yield pa.RecordBatch.from_arrays(columns, ["feature", "seen", "hits"])


def deviations(documents: DataFrame, labels: DataFrame, name: str, most: int = LABEL_BYTES) -> np.ndarray:
    """By feature: how far its documents are from being toxic by chance, in standard deviations, over
    all labelled documents. Rows with one id weigh one document together. The driver gets a row per
    hashed feature. Labels of LABEL_BYTES at most go to the texts; larger ones meet them in a shuffle."""
    rows = documents.groupBy(F.col("doc_id").alias("row_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = _labelled(labels, name).join(rows, F.col("doc_id") == F.col("row_id"))
    known = staged(known.select(F.col("doc_id").alias("known_id"), "label", (1 / F.col("n_rows")).alias("weight")))
    size = known.agg(F.sum(F.length(F.col("known_id").cast("string")) + 32)).first()[0] or 0
    known = F.broadcast(known) if size <= most else known
    texts = documents.select(F.col("doc_id").alias("text_id"), F.col("text").cast("string").alias("text"))
    drawn = texts.join(known, F.col("text_id") == F.col("known_id")).select("label", "weight", "text")
    counted = drawn.mapInArrow(_counts, "feature int, seen double, hits double").groupBy("feature")
    table = counted.agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits")).toArrow()
    seen, hits = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    seen[table["feature"].to_numpy()], hits[table["feature"].to_numpy()] = table["seen"].to_numpy(), table["hits"].to_numpy()
    rate = hits[-1] / max(seen[-1], 1e-9)
    return ((hits - rate * seen) / np.sqrt(np.maximum(rate * (1 - rate) * seen, 1e-9)))[:-1]


def one_text_each(drawn: DataFrame) -> DataFrame:
    """label and text of one row of each text_id, by a hash of the text: an id with many rows counts
    once, and its rows are reduced where they are read."""
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return drawn.groupBy("text_id", "label").agg(least).select("label", "text")


def training_sample(documents: DataFrame, labels: DataFrame, name: str, each: int) -> DataFrame:
    """label, text and place (from 1 in each class) of at most `each` labelled documents of either class, a
    row each, by a hash of the id. The ids are at most 2 * each rows, so the documents meet them where
    they are read."""
    known = _labelled(labels, name)
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = [known.where(F.col("label") == value).orderBy(*order).limit(each) for value in (0, 1)]
    by_hash = Window.partitionBy("label").orderBy(*order)
    ids = chosen[0].union(chosen[1]).withColumn("place", F.row_number().over(by_hash))
    ids = ids.select(F.col("doc_id").alias("known_id"), "label", "place")
    texts = documents.select(F.col("doc_id").alias("text_id"), F.col("text").cast("string").alias("text"))
    drawn = texts.join(F.broadcast(ids), F.col("text_id") == F.col("known_id"))
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return drawn.groupBy("text_id", "label", "place").agg(least).select("label", "place", "text")


def fit_ordinal(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the weighted log-likelihood; toxic and clean documents weigh
    the same in all. Row i of the sparse matrix has entries starts[i] to starts[i + 1]; grades from 0.
    Beside the matrix the working arrays hold a block of rows."""
    n, levels = len(grades), GRADES - 1
    ends = np.searchsorted(starts, np.arange(0, starts[-1], BLOCK_ENTRIES), side="right") - 1
    bounds = np.unique(np.append(ends, n))
    blocks = [(a, b, slice(starts[a], starts[b]), np.diff(starts[a : b + 1])) for a, b in zip(bounds[:-1], bounds[1:])]
    toxic = grades > 0
    weight = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    parameters = np.concatenate([np.zeros(width), [1.0], np.zeros(levels - 1)])  # first threshold, log gaps
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        w = parameters[:width]
        narrow = w.astype(np.float32)
        gaps = np.exp(parameters[width + 1 :])
        thresholds = parameters[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.zeros(n)
        for a, b, part, length in blocks:
            full = np.flatnonzero(length)
            if len(full):
                score[a + full] = np.add.reduceat(values[part] * narrow[columns[part]], starts[a + full] - starts[a])
        below = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds[None, :], -60, 60)))  # P(grade <= k)
        padded = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        chance = np.maximum(padded[np.arange(n), grades + 1] - padded[np.arange(n), grades], 1e-12)
        slope = below * (1 - below)  # of P(grade <= k) in its threshold
        slopes = np.concatenate([np.zeros((n, 1)), slope, np.zeros((n, 1))], axis=1)
        up = slopes[np.arange(n), grades + 1] / chance * weight
        down = slopes[np.arange(n), grades] / chance * weight
        by_threshold = np.zeros(levels)
        for k in range(levels):
            by_threshold[k] = up[grades == k].sum() - down[grades == k + 1].sum()
        by_score = (down - up).astype(np.float32)
        gradient = np.empty_like(parameters)  # of the log-likelihood
        gradient[:width] = -DECAY * w
        for a, b, part, length in blocks:
            gradient[:width] += np.bincount(columns[part], values[part] * np.repeat(by_score[a:b], length), width)
        gradient[width] = by_threshold.sum()
        gradient[width + 1 :] = [by_threshold[k + 1 :].sum() * gaps[k] for k in range(levels - 1)]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
        parameters += 0.1 * (1 - step / (STEPS + 1)) * move
    gaps = np.exp(parameters[width + 1 :])
    return parameters[:width], parameters[width] + np.concatenate([[0.0], np.cumsum(gaps)])


def _within(rows: DataFrame, entries: int) -> DataFrame:
    """The first rows of each class, by place, that hold half of `entries` features in all at most, one
    row of each at least. The driver sees two numbers a row."""
    sizes = rows.select("label", "place", F.size("ids").alias("size")).orderBy("label", "place").toPandas()
    held = sizes.groupby("label")["size"].cumsum()
    last = sizes[(held <= entries // 2) | (sizes["place"] == sizes.groupby("label")["place"].transform("min"))]
    most = last.groupby("label")["place"].max().to_dict()
    return rows.where(F.col("place") <= F.when(F.col("label") == 1, most.get(1, 0)).otherwise(most.get(0, 0)))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Ordinal:
    """The model of a bounded sample: the driver holds `entries` features at most (or those of two
    documents), eight bytes each, and twice while they arrive."""
    with scratch(documents.sparkSession):
        far = deviations(documents, labels, "toxic")
        trust = (np.minimum(1, np.abs(far) / FULL_DEVIATION) ** TRUST_POWER).astype(np.float32)
        drawn = training_sample(documents, labels, "toxic", sample)
        rows = staged(drawn.mapInArrow(_sparse, "place int, label int, n int, ids array<int>, counts array<int>"))
        got = _within(rows, entries).orderBy("label", "place").toArrow()
    toxic, n = got["label"].to_numpy() == 1, got["n"].to_numpy()
    if not len(got) or toxic.all() or not toxic.any():
        return Ordinal()
    starts = np.append(0, np.cumsum(pc.list_value_length(got["ids"]).to_numpy())).astype(np.int64)
    columns, values = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.float32)
    at = row = 0
    for batch in got.to_batches():
        ids = batch["ids"].flatten().to_numpy()
        length = np.diff(starts[row : row + len(batch) + 1])
        per_word = np.repeat((100 / (n[row : row + len(batch)] + DAMPING)).astype(np.float32), length)
        columns[at : at + len(ids)] = ids
        values[at : at + len(ids)] = batch["counts"].flatten().to_numpy() * per_word * trust[ids]
        at, row = at + len(ids), row + len(batch)
    del got, batch, ids, length, per_word
    if not values.any():
        return Ordinal()
    density = np.zeros(len(n))
    for row in np.flatnonzero(toxic):
        part = slice(starts[row], starts[row + 1])
        density[row] = values[part][far[columns[part]] > 0].sum()
    cuts = np.quantile(density[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + np.searchsorted(cuts, density, side="left"), 0)
    fitted, thresholds = fit_ordinal(starts, columns, values, grades, 1 << BITS)
    return Ordinal((100 * fitted * trust).astype(np.float32), thresholds)


def grade_documents(documents: DataFrame, model: Ordinal, carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, severity (expected grade, 0 to 3), p_toxic, grade (likeliest), toxic; or,
    with `carry`, all columns given and a last one, p_toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for begin, end in slices(texts):
            score, n = scores(texts.slice(begin, end - begin), shared.value.weights)
            above = shared.value.above(score)
            above[n == 0] = 0
            parts.append(above)
        above = np.concatenate(parts) if parts else np.zeros((0, GRADES - 1))
        chances = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1), axis=1)
        return above, chances.argmax(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above, grade = judge(batch["text"])
            toxic = above[:, 0] >= 0.5
            columns = [batch["doc_id"], pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(grade.astype(np.int32)), pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above, _ = judge(batch["text"])
            yield batch.filter(pa.array(above[:, 0] < 0.5))

    if carry is not None:
        carried = documents.select(*quoted(carry))
        return carried.mapInArrow(keep, carried.schema)
    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic boolean")


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, in all their columns."""
    return grade_documents(documents, fit(documents, labels), documents.columns)
