"""Embedding near-duplicates: tiles of int8 products with proven error bounds.

A unit vector u is s * q + e with codes q in int8, so the cosine of u and w differs from s t (q . r) by
at most |e_u| + |e_w| + |e_u| |e_w|. Codes of a label are multiplied tile by tile (exactly: the sums of
up to 1024 products fit a float's 24 bits); only pairs whose bound reaches the threshold are computed
in double precision. A tile gives sums of links and a spanning forest, never its list of pairs.

Equal vectors become one node first, so a vector with many copies costs one row. Comparing all rows
of a label is quadratic by contract; tiles of fixed size share that work out evenly.

Defined results: rows whose label is NULL, or whose vector is NULL, empty, zero, or holds NULL or
non-finite components, link with nothing; so do vectors of different lengths. Rows with one vec_id
are one vector; NULL vec_ids link with nothing. An empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import scratch, staged
from tillflow.llm.components import components
from tillflow.llm.minhash import _groups
from tillflow.llm.words import mix

THRESHOLD = 0.93
TILE = 1024
_EXACT = 1024
_CODED = "vec_id long, label long, dim int, key_a long, key_b long, codes binary, scale double, error double, vector binary"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error norms of unit vectors (rows)."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - scale[:, None] * codes, axis=1)
    return codes, scale, error


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["embedding"]
        rows = []
        by_length: dict[int, list[int]] = {}
        for row, (own, label, vector) in enumerate(zip(batch["vec_id"], batch["label"], lists)):
            if own.is_valid and label.is_valid and vector.is_valid and len(vector.values) and not vector.values.null_count:
                by_length.setdefault(len(vector.values), []).append(row)
        for dim, places in by_length.items():
            vectors = np.stack([lists[row].values.to_numpy() for row in places]).astype(np.float64)
            vectors += 0.0  # one zero
            with np.errstate(over="ignore", invalid="ignore"):
                # Scaled first, so that the squares of very large or small numbers stay in range.
                top = np.abs(vectors).max(axis=1)
                fine = np.isfinite(top) & (top > 0)
                vectors, top, places = vectors[fine], top[fine], np.array(places)[fine]
            if not len(vectors):
                continue
            unit = vectors / top[:, None]
            unit /= np.linalg.norm(unit, axis=1)[:, None]
            codes, scale, error = quantise(unit)
            words = vectors.view(np.uint64)
            odd = mix(np.arange(1, dim + 1, dtype=np.uint64)) | np.uint64(1)
            key_a, key_b = (mix(words ^ salt) * odd for salt in (np.uint64(0), np.uint64(0x9E3779B97F4A7C15)))
            rows.append((places, dim, key_a.sum(axis=1), key_b.sum(axis=1), codes, scale, error, unit))
        for places, dim, key_a, key_b, codes, scale, error, unit in rows:
            taken = batch.select(["vec_id", "label"]).take(pa.array(places))
            columns = [
                taken["vec_id"], taken["label"], pa.array(np.full(len(places), dim, np.int32)),
                pa.array(key_a.view(np.int64)), pa.array(key_b.view(np.int64)),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(error),
                pa.array([u.tobytes() for u in unit], pa.binary()),
            ]
            names = [part.split()[0] for part in _CODED.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)


def linked(codes_a, scale_a, error_a, unit_a, codes_b, scale_b, error_b, unit_b, threshold: float) -> np.ndarray:
    """Which rows of a link with which rows of b, as a matrix."""
    product = np.zeros((len(codes_a), len(codes_b)))
    for at in range(0, codes_a.shape[1], _EXACT):
        part = slice(at, at + _EXACT)
        product += codes_a[:, part].astype(np.float32) @ codes_b[:, part].astype(np.float32).T
    product *= scale_a[:, None] * scale_b[None, :]
    # A little above the bound, for the rounding of the bound itself.
    product += error_a[:, None] + error_b[None, :] + error_a[:, None] * error_b[None, :] + 1e-12
    links = product >= threshold
    left, right = np.nonzero(links)
    for at in range(0, len(left), 1 << 15):
        i, j = left[at : at + (1 << 15)], right[at : at + (1 << 15)]
        links[i, j] = np.einsum("ij,ij->i", unit_a[i], unit_b[j]) >= threshold
    return links


def forest(links: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """A root and all others of each component of a symmetric matrix with more than one row."""
    open_ = links.any(axis=1)
    found = []
    while open_.any():
        root = int(np.argmax(open_))
        seen = np.zeros(len(links), bool)
        front = np.zeros(len(links), bool)
        seen[root] = front[root] = True
        while front.any():
            front = links[front].any(axis=0) & ~seen
            seen |= front
        open_ &= ~seen
        seen[root] = False
        found.append((root, np.flatnonzero(seen)))
    return found


def _tile_links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["space", "low", "high"]
        for table in _groups(batches, keys):
            columns = [table[key].to_numpy() for key in keys]
            cuts = np.flatnonzero(np.any([np.diff(c, prepend=c[0] - 1) != 0 for c in columns], axis=0))
            for begin, end in zip(cuts, [*cuts[1:], len(table)]):
                tile = table.slice(begin, end - begin)
                node, chunk, copies = (tile[c].to_numpy() for c in ("node", "chunk", "copies"))
                codes = np.frombuffer(b"".join(tile["codes"].to_pylist()), np.int8).reshape(len(tile), -1)
                unit = np.frombuffer(b"".join(tile["vector"].to_pylist()), np.float64).reshape(len(tile), -1)
                scale, error = tile["scale"].to_numpy(), tile["error"].to_numpy()
                links = np.zeros((len(tile), len(tile)), bool)
                a = np.flatnonzero(chunk == columns[1][begin])
                b = np.flatnonzero(chunk == columns[2][begin])
                side = lambda rows: (codes[rows], scale[rows], error[rows], unit[rows])  # noqa: E731, B023
                if len(a) and len(b):
                    links[np.ix_(a, b)] = linked(*side(a), *side(b), threshold)
                links |= links.T
                np.fill_diagonal(links, False)
                if not links.any():
                    continue
                count = links @ copies
                some = np.flatnonzero(count)
                stars = forest(links)
                roots = np.concatenate([np.full(len(others), node[root]) for root, others in stars])
                others = np.concatenate([node[others] for _, others in stars])
                a = pa.array(np.concatenate([node[some], roots]))
                b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(others)])
                n = pa.array(np.concatenate([count[some], np.zeros(len(roots), np.int64)]))
                yield pa.RecordBatch.from_arrays([a, b, n], ["a", "b", "n"])

    return run


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. The result is a written table; what led to it is
    deleted."""
    with scratch(embeddings.sparkSession) as keep:
        return keep(staged(_linked(embeddings, threshold)))


def _linked(embeddings: DataFrame, threshold: float) -> DataFrame:
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    coded = staged(rows.mapInArrow(_code, _CODED))
    same = ["label", "dim", "key_a", "key_b"]
    members = coded.select("vec_id", *same).distinct()
    nodes = staged(members.groupBy(*same).agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    member = staged(members.join(nodes, same).select("vec_id", "node", "copies"))

    counts = nodes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    chunks = counts.select("label", "dim", F.ceil(F.col("size") / TILE).cast("int").alias("chunks"))
    first = coded.join(nodes, same).where("vec_id = node").dropDuplicates(["node", *same])
    spread = (
        first.join(chunks, ["label", "dim"])
        .withColumn("chunk", F.pmod(F.xxhash64("key_a", "key_b"), F.col("chunks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("label", "dim").alias("space"), F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"),
            "chunk", "node", "copies", "codes", "scale", "error", "vector",
        )
    )
    tiles = spread.repartition("space", "low", "high").sortWithinPartitions("space", "low", "high")
    found = staged(tiles.mapInArrow(_tile_links(threshold), "a long, b long, n long"))

    counted = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    per_row = member.join(counted, "node", "left")
    per_id = per_row.groupBy("vec_id").agg(
        F.max(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links")
    )
    edges = found.where("b IS NOT NULL").select("a", "b")
    edges = edges.union(member.where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b")))
    final = components(edges).withColumnRenamed("node", "vec_id")
    return (
        rows.select("vec_id")
        .join(per_id, "vec_id", "left")
        .join(final, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            (F.col("component").isNull() | F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True))).alias("kept"),
        )
    )
