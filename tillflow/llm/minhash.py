"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard verification.

Two permutations of the 2**32 shingle places serve all coordinates: places are scrambled once by the
first, and coordinate k is the least value under the second permutation shifted by k. Bands of four
coordinates bring candidates together: a pair at Jaccard 0.8 misses all 32 bands with probability
(1 - 0.8**4)**32 = 5e-8. Candidates are confirmed on the full shingle sets of their texts.

No pairs of a group are listed. Equal shingle sets become one node; every node is compared with the
most central node of each band; what this links is one component, and only nodes of different
components are then compared within a band, in tiles, first by signature. Pairs whose signatures
agree in less than 0.8 - 5 standard deviations go no further; the others are all compared by their
full sets, in the tile, which gives the links that join components and nothing else.

Defined results: texts that are NULL or without words have no shingles, link with nothing and are
kept; NULL doc_ids link with nothing and are kept with component NULL; rows with one doc_id are one
document, and linked where any of their texts are; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import quoted, scratch, staged
from tillflow.llm.components import components
from tillflow.llm.words import mix, slices, words
from tillflow.session import session_conf

PERCENT = 80
#: Ids that several rows share are broadcast up to so many.
BROADCAST_ROWS = 1_000_000
BANDS = 32
ROWS = 4
COORDINATES = BANDS * ROWS
#: 0.8 less five standard deviations of the agreement of 128 coordinates.
LEAST_AGREEMENT = 0.62
TILE = 512
#: Texts handed to a Python worker at a time.
BATCH = 1000

_PLACES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)]
_FIRST = np.uint32(0x85EBCA6B)
_SECOND = np.uint32(0xC2B2AE35)
_BLOCK = 1 << 15


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of all texts on end, sorted within each, and where each set begins.
    With fewer words than `width` the whole sequence is the one shingle."""
    found = words(texts)
    hashes = found.hashes()
    place = _PLACES[:width]
    rows = len(hashes) - width + 1
    runs = np.zeros(max(rows, 0), np.uint64)
    for at, factor in enumerate(place):
        runs += hashes[at : at + len(runs)] * factor
    runs = mix(runs)
    sets, starts = [], np.zeros(len(texts) + 1, np.int64)
    for row in range(len(texts)):
        begin, end = found.first[row], found.first[row + 1]
        if end - begin >= width:
            own = np.unique(runs[begin : end - width + 1])
        elif end > begin:
            short = np.sum(hashes[begin:end] * np.array(place[: end - begin]), dtype=np.uint64)
            own = mix(np.array([short + np.uint64(end - begin)], np.uint64))
        else:
            own = np.zeros(0, np.uint64)
        sets.append(own)
        starts[row + 1] = starts[row] + len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), starts


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of each circulant coordinate, one row per set; sets without shingles give zeros."""
    n = len(starts) - 1
    least = np.full((COORDINATES, n), 0xFFFFFFFF, np.uint32)
    # The first permutation: hashes are scrambled places already; 32 bits of them, times an odd number.
    places = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32) * _FIRST
    owner = np.repeat(np.arange(n), np.diff(starts))
    buffer, shifted = np.empty(_BLOCK, np.uint32), np.empty(_BLOCK, np.uint32)
    for begin in range(0, len(places), _BLOCK):
        block = places[begin : begin + _BLOCK]
        own = owner[begin : begin + _BLOCK]
        cuts = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
        sets = own[cuts]
        x, y = buffer[: len(block)], shifted[: len(block)]
        for k in range(COORDINATES):
            # The second permutation at place - k: the odd factor is already in, so shift by k times it.
            np.subtract(block, np.uint32(k * int(_FIRST) & 0xFFFFFFFF), out=x)
            np.right_shift(x, 15, out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, _SECOND, out=x)
            least[k, sets] = np.minimum(least[k, sets], np.minimum.reduceat(x, cuts))
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    bits[:, np.diff(starts) == 0] = 0
    return np.ascontiguousarray(bits.T)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (total[starts[1:]] - total[starts[:-1]]).view(np.int64)


_SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch["text"]):
                shingles, starts = shingle_sets(batch["text"].slice(begin, end - begin), width)
                packed = signatures(shingles, starts).view(np.int64)
                offsets = np.arange(0, packed.size + 1, BANDS, dtype=np.int32)
                columns = [
                    batch["doc_id"].slice(begin, end - begin),
                    pa.array(np.diff(starts)),
                    pa.array(_sums(mix(shingles), starts)),
                    pa.array(_sums(mix(shingles * _PLACES[1]), starts)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(packed.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return run


def _lists(column: pa.Array) -> np.ndarray:
    """Rows of packed bands as rows of 16-bit coordinates."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, BANDS)).view(np.uint16)


def _sizes_fit(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        agree = (_lists(batch["bands_a"]) == _lists(batch["bands_b"])).mean(axis=1)
        fit = _sizes_fit(batch["n_a"].to_numpy(), batch["n_b"].to_numpy()) & (agree >= LEAST_AGREEMENT)
        yield batch.select(["a", "b"]).filter(pa.array(fit))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that are sorted by the keys; a group may span batches."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        columns = [table[key].to_numpy() for key in keys]
        new = np.zeros(len(table), bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        cuts = np.flatnonzero(new)
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None and len(held):
        yield held


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, bool]]:
    """Tiles one by one, which of their rows come from the first of two chunks, and whether there is
    one chunk only: then all rows are paired, else rows of one chunk with rows of the other."""
    keys = ["band", "low", "high"]
    for table in _groups(batches, keys):
        columns = [table[key].to_numpy() for key in keys]
        cuts = np.flatnonzero(np.any([np.diff(c, prepend=c[0] - 1) != 0 for c in columns], axis=0))
        chunk = table["chunk"].to_numpy()
        for begin, end in zip(cuts, [*cuts[1:], len(table)]):
            one = columns[1][begin] == columns[2][begin]
            side = np.zeros(end - begin, bool) if one else chunk[begin:end] == columns[1][begin]
            yield table.slice(begin, end - begin), side, one


def _candidates(i: int, nth: int, bits: np.ndarray, size: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Later rows that may be linked with row i and share no band before this one with it, so that a
    pair is looked at in one band only."""
    at = np.flatnonzero(open_[i + 1 :] & _sizes_fit(size[i + 1 :], size[i])) + i + 1
    at = at[(bits[at] == bits[i]).mean(axis=1) >= LEAST_AGREEMENT]
    whole = bits.view(np.int64)
    return at[(whole[at] == whole[i]).argmax(axis=1) == nth]


def _open_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that have to be compared with a node of another component in their band."""
    for tile, side, one in _tiles(batches):
        node, label, size = (tile[c].to_numpy() for c in ("node", "label", "n"))
        bits, nth = _lists(tile["bands"].combine_chunks()), int(tile["nth"][0].as_py())
        needed = np.zeros(len(tile), bool)
        for i in range(len(tile) - 1):
            open_ = (label != label[i]) & ((side != side[i]) | one)
            at = _candidates(i, nth, bits, size, open_)
            needed[at] = True
            needed[i] |= len(at) > 0
        if needed.any():
            yield pa.RecordBatch.from_arrays([tile["band"].combine_chunks().filter(pa.array(needed)), pa.array(node[needed])], ["band", "node"])


def _tile_links(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between nodes of different components, found on the full sets of both. A link whose
        ends an earlier one of the tile has joined is not looked for."""
        for tile, side, one in _tiles(batches):
            node, label, size = (tile[c].to_numpy() for c in ("node", "label", "n"))
            bits, nth = _lists(tile["bands"].combine_chunks()), int(tile["nth"][0].as_py())
            texts, sets = tile["text"].combine_chunks(), []
            for begin, end in slices(texts):
                shingles, starts = shingle_sets(texts.slice(begin, end - begin), width)
                sets += [shingles[x:y] for x, y in zip(starts[:-1], starts[1:])]
            known, places = np.unique(np.concatenate(sets), return_inverse=True)
            places = np.split(places, np.cumsum([len(own) for own in sets])[:-1])
            joined, here, ends = label.copy(), np.zeros(len(known), bool), []
            for i in range(len(tile) - 1):
                at = _candidates(i, nth, bits, size, (joined != joined[i]) & ((side != side[i]) | one))
                if not len(at):
                    continue
                here[places[i]] = True
                both = np.array([np.count_nonzero(here[places[j]]) for j in at])
                here[places[i]] = False
                for j in at[100 * both >= PERCENT * (len(places[i]) + np.array([len(places[j]) for j in at]) - both)]:
                    if joined[j] != joined[i]:
                        joined[joined == joined[j]] = joined[i]
                        ends.append((node[i], node[j]))
            if ends:
                a, b = zip(*ends)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _verify(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in slices(whole["text_b"]):
                batch = whole.slice(begin, end - begin)
                sides = []
                for side in ("a", "b"):
                    # A hub's text comes once per pair; its set is made once per slice.
                    _, rows, back = np.unique(batch[side].to_numpy(), return_index=True, return_inverse=True)
                    texts, sets = batch[f"text_{side}"].take(pa.array(rows)), []
                    for first, last in slices(texts):
                        shingles, starts = shingle_sets(texts.slice(first, last - first), width)
                        sets += [shingles[x:y] for x, y in zip(starts[:-1], starts[1:])]
                    sides.append((sets, back))
                (sets_a, back_a), (sets_b, back_b) = sides
                linked = np.zeros(batch.num_rows, bool)
                for row in range(batch.num_rows):
                    x, y = sets_a[back_a[row]], sets_b[back_b[row]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked[row] = both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)
                yield batch.select(["a", "b"]).filter(pa.array(linked))

    return run


def _mixed_bands(labelled: DataFrame) -> DataFrame:
    """Rows of bands that hold nodes of more than one component, and how many chunks they make."""
    sizes = labelled.groupBy("band").agg(F.count("*").alias("size"), F.min("label").alias("one"), F.max("label").alias("other"))
    mixed = sizes.where("one <> other").select("band", F.ceil(F.col("size") / TILE).cast("int").alias("chunks"))
    return labelled.join(mixed, "band")


def _tiled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows with what is known of their nodes, once for every tile they are part of."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).join(nodes, "node")
    low, high = F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high")
    tiles = rows.select("band", low, high, "nth", "chunk", "node", "label", *nodes.drop("node").columns)
    return tiles.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")


def link_documents(documents: DataFrame, width: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Links are Jaccard >= 0.8 of `width`-word
    shingles, lower-cased A to Z. The result is a written table; what led to it is deleted."""
    spark = documents.sparkSession
    with scratch(spark) as keep, session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH}):
        return keep(staged(_linked(documents, width)))


def _linked(documents: DataFrame, width: int) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = staged(docs.mapInArrow(_sketch(width), _SKETCH))
    filled = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same_set = ["n_shingles", "set_a", "set_b"]
    nodes = staged(filled.groupBy(*same_set).agg(F.min("doc_id").alias("node")))
    member = filled.join(nodes, same_set)
    copies = member.select("doc_id", "node").where("doc_id <> node")
    # Rows with one doc_id may give a node several sets; each of them is compared.
    sets = staged(member.where("doc_id = node").select("node", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["node", "n"]))

    rows = sets.select("node", F.posexplode("bands").alias("nth", "bits"))
    rows = rows.select("node", "nth", F.xxhash64("nth", "bits").alias("band"))
    sizes = staged(rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"))
    shared = staged(rows.join(sizes, "band").select("band", "nth", "node", "size"))
    central = staged(shared.groupBy("node").agg(F.sum("size").alias("weight")))
    hubs = shared.join(central, "node").groupBy("band").agg(F.max_by("node", "weight").alias("hub"))
    shared = shared.join(staged(hubs), "band").where("node <> hub").select("band", "nth", "node", "hub")

    # Texts and sketches of nodes that share a band: everything below reads these alone.
    texts = staged(docs.join(central.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"))
    sketches = staged(sets.join(central.select("node"), "node", "left_semi"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)
        return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width), "a long, b long")

    first = shared.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    for side in ("a", "b"):
        own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bands").alias(f"bands_{side}"))
        first = first.join(own, side)
    first = first.select("a", "b", "n_a", "n_b", "bands_a", "bands_b").mapInArrow(_likely, "a long, b long")
    label = components(confirmed(first))
    labelled = shared.join(label, "node", "left").select("band", "nth", "node", F.coalesce("component", "node").alias("label"))
    # A pair meets in the first band it shares, unless one of the two was the hub there.
    labelled = staged(labelled)
    found = _mixed_bands(labelled)
    found = staged(_tiled(found, sketches).mapInArrow(_open_nodes, "band long, node long").distinct())
    found = _mixed_bands(labelled.join(found, ["band", "node"], "left_semi"))
    tiles = _tiled(found, sketches.join(texts.select(F.col("doc_id").alias("node"), "text"), "node"))
    links = tiles.mapInArrow(_tile_links(width), "a long, b long")

    edges = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
    edges = edges.union(links).union(copies.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    final = components(edges)
    return sketch.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")), F.lit(True)).alias("kept"),
    )


def one_of_each(documents: DataFrame, width: int = 5, most: int = BROADCAST_ROWS) -> DataFrame:
    """The documents that stay: of each group of near copies the one with the least doc_id, and of equal
    rows of it one. Rows that share a doc_id, or have none, are documents of their own, known by a hash of
    id and text: a text goes only as a near copy of one that stays."""
    row_id, body = F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    shared = documents.groupBy(row_id.alias("shared_id")).agg(F.count(F.lit(1)).alias("n"))
    shared = staged(shared.where("n > 1 AND shared_id IS NOT NULL").select("shared_id"))
    # Few ids go to the texts; many meet them in a shuffle.
    shared = F.broadcast(shared) if shared.limit(most + 1).count() <= most else shared
    rows = documents.select(F.struct(*quoted(documents.columns)).alias("row"), row_id.alias("row_id"), body.alias("body"))
    rows = rows.join(shared, F.col("row_id") == F.col("shared_id"), "left")
    own = F.col("shared_id").isNull() & F.col("row_id").isNotNull()
    node = F.when(own, F.col("row_id").cast("long")).otherwise(F.xxhash64(F.lit("row"), "row_id", "body"))
    rows = rows.select("row", node.alias("node"), own.alias("own"), "body")
    linked = link_documents(rows.select(F.col("node").alias("doc_id"), F.col("body").alias("text")), width)
    kept = staged(linked.where("kept").select(F.col("doc_id").alias("node")).distinct())
    joined = rows.select("row", "node", "own").join(kept, "node", "left_semi")
    # Equal rows are reduced where they are read, by a hash of all their columns.
    order = F.struct(F.xxhash64(F.to_json("row")), F.to_json("row"))
    repeated = joined.where("NOT own").groupBy("node").agg(F.min_by("row", order).alias("row"))
    return joined.where("own").select("row.*").unionByName(repeated.select("row.*"))
