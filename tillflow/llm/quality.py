"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text is a bag of hashed words, of word shapes (runs of letter case, digits and signs) and of a few
habits (repeated words, word lengths). Shares are square-rooted, weighted by rarity, centred and
projected on the leading singular directions of the labelled sample. Its vectors are broadcast
(SAMPLE * DIMENSIONS numbers at most), every document is compared with all of them in blocks of exact
cosine products, and the K nearest vote with their similarity.

The sample: at most SAMPLE labelled documents by a hash of the id, none with crc32(doc_id) mod 4 = 2.

Defined results: texts that are NULL, empty or without words score 0; labels that are NULL or whose
document is missing are not learned from; ids labelled twice count as the lower label; without labels
every text with words scores 1; NULL doc_ids are not held out; repeated rows score alike; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.toxicity import one_text_each
from tillflow.llm.words import _BYTE, Words, _powers, buffers, mix, slices, words

#: Texts counted at a time: a row of WIDTH counts each, however short they are.
SLICE_ROWS = 1000
SAMPLE = 5000
DIMENSIONS = 64
K = 21
THRESHOLD = 0.7
WORDS, SHAPES, HABITS = 2048, 1024, 64
WIDTH = WORDS + SHAPES + HABITS
#: How much each kind of feature counts before the vectors are brought to length 1.
SHARE = {"words": 0.5, "shapes": 1.0, "habits": 1.0}

# Classes of bytes for shapes: 0 space, 1 lower case (and all of non-ASCII), 2 upper case, 3 digit;
# every other sign is a class of its own.
_CLASS = np.full(256, 1, np.uint8)
for _byte in range(128):
    _sign = chr(_byte)
    _CLASS[_byte] = 0 if _sign.isspace() else 1 if _sign.islower() else 2 if _sign.isupper() else 3 if _sign.isdigit() else 4 + _byte


@dataclass
class Neighbours:
    rarity: np.ndarray
    mean: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _shapes(texts: pa.Array, found: Words) -> np.ndarray:
    """A hash of the runs of byte classes of each word: "The!!" and "Of!!!" are alike."""
    data, _ = buffers(texts)
    kind = _CLASS[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[found.start] = True
    runs = np.flatnonzero(new & (kind > 0))
    sums = np.zeros(len(runs) + 1, np.uint64)
    np.cumsum(_BYTE[kind[runs]] * _powers("up", len(runs) + 1)[: len(runs)], out=sums[1:], dtype=np.uint64)
    first, last = np.searchsorted(runs, found.start), np.searchsorted(runs, found.stop)
    return mix((sums[last] - sums[first]) * _powers("down", len(runs) + 1)[first])


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts, a row per text, and the number of words of each."""
    found = words(texts)
    n = np.diff(found.first)
    hashed = found.hashes()
    row = found.doc * WIDTH
    features = [
        row + (hashed >> np.uint64(64 - 11)).astype(np.int64),
        row + WORDS + (_shapes(texts, found) >> np.uint64(64 - 10)).astype(np.int64),
        row + WORDS + SHAPES + np.minimum(found.stop - found.start, 31),
    ]
    for habit, apart in enumerate((1, 2, 3, 4)):
        again = np.flatnonzero((hashed[apart:] == hashed[:-apart]) & (found.doc[apart:] == found.doc[:-apart]))
        features.append(row[again] + WORDS + SHAPES + 32 + habit)
    total = len(n) * WIDTH
    return np.bincount(np.concatenate(features), minlength=total).reshape(len(n), WIDTH).astype(np.float32), n


def shares(counted: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Square roots of shares of words, by kind."""
    roots = np.sqrt(counted / np.maximum(n, 1)[:, None], dtype=np.float32)
    roots[:, :WORDS] *= SHARE["words"]
    roots[:, WORDS : WORDS + SHAPES] *= SHARE["shapes"]
    roots[:, WORDS + SHAPES :] *= SHARE["habits"]
    return roots


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in slices(batch["text"], rows=SLICE_ROWS):
            counted, n = counts(batch["text"].slice(begin, end - begin))
            rows, places = np.nonzero(counted)
            cuts = np.searchsorted(rows, np.arange(1, len(n)))
            lists = [np.split(values, cuts) for values in (places.astype(np.int32), counted[rows, places].astype(np.int32))]
            columns = [batch["label"].slice(begin, end - begin), pa.array(n.astype(np.int32))]
            columns += [pa.array(values, pa.list_(pa.int32())) for values in lists]
            yield pa.RecordBatch.from_arrays(columns, ["label", "n", "ids", "counts"])


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours | None:
    """Directions and labelled vectors of the sample; None if there are no labels."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    ids = F.broadcast(chosen.select(F.col("doc_id").alias("known_id"), "label"))  # at most `sample` rows
    texts = documents.select(F.col("doc_id").alias("text_id"), F.col("text").cast("string").alias("text"))
    drawn = one_text_each(texts.join(ids, F.col("text_id") == F.col("known_id")))
    rows = drawn.mapInArrow(_sparse, "label int, n int, ids array<int>, counts array<int>").toArrow().combine_chunks()
    rows = rows.filter(pa.array(rows["n"].to_numpy() > 0))
    if not len(rows):
        return None
    matrix = np.zeros((len(rows), WIDTH), np.float32)
    ids = rows["ids"].combine_chunks()
    owner = np.repeat(np.arange(len(rows)), np.diff(ids.offsets.to_numpy()))
    matrix[owner, ids.flatten().to_numpy()] = rows["counts"].combine_chunks().flatten().to_numpy()
    order = np.lexsort((rows["label"].to_numpy(), rows["n"].to_numpy(), matrix.sum(axis=1)))
    matrix, n, label = matrix[order], rows["n"].to_numpy()[order], rows["label"].to_numpy()[order]
    rarity = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    matrix = _unit(shares(matrix, n) * rarity)
    mean = matrix.mean(axis=0)
    matrix -= mean
    # Randomised range finding, three rounds: the leading right singular vectors.
    basis = np.random.default_rng(7).standard_normal((WIDTH, DIMENSIONS + 16)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    directions = (basis @ right.T[:, :DIMENSIONS]).astype(np.float32)
    return Neighbours(rarity, mean, directions, _unit(matrix @ directions), label.astype(np.float32))


def vote(texts: pa.Array, model: Neighbours | None) -> np.ndarray:
    """Similarity-weighted share of label 1 among the K nearest labelled vectors."""
    counted, n = counts(texts)
    if model is None:
        return (n > 0).astype(float)
    latent = _unit((_unit(shares(counted, n) * model.rarity) - model.mean) @ model.directions)
    cosine = latent @ model.vectors.T
    k = min(K, cosine.shape[1])
    nearest = np.argpartition(cosine, cosine.shape[1] - k, axis=1)[:, -k:]
    weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 1e-6).astype(np.float64) ** 2
    score = (weight * model.labels[nearest]).sum(axis=1) / weight.sum(axis=1)
    return np.where(n > 0, np.clip(score, 0, 1), 0.0)


def score_documents(documents: DataFrame, model: Neighbours | None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch["text"], rows=SLICE_ROWS):
                score = vote(batch["text"].slice(begin, end - begin), shared.value)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(begin, end - begin), pa.array(score)], ["doc_id", "score"])

    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    scored = narrow.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
