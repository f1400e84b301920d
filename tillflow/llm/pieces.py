"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces and their log scores come from a model file, which is read once on the driver; nothing is
trained. Spaces become the marker, one marker is put in front, and a text is cut before each run of
markers: no piece holds a marker after another sign, so the best path of the whole is the best paths
of its parts on end. Distinct parts of a slice of texts are solved together, position by position.
Ties go to the earlier start of the last piece. A sign no piece covers becomes its UTF-8 bytes.

Defined results: NULL text gives NULL ids; the empty text gives no ids; decoding gives back every
text, but the marker itself (U+2581) comes back as a space; repeated rows are encoded alike; NULL
doc_ids are kept; an empty table gives no rows; other columns are ignored or, for `encoded`, carried.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Below the least score of any piece, as far as an unknown sign is.
UNKNOWN = 10.0
#: Parts whose ids a worker remembers.
REMEMBERED = 200_000
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Trie:
    """A double-array trie over bytes: the child of state s by byte c is base[s] + c where check of
    that place is s. value: the piece that ends in a state, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(words: Iterable[tuple[bytes, int]]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for word, piece in words:
            node = 0
            for byte in word:
                after = children[node].get(byte)
                if after is None:
                    after = children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = after
            ends[node] = piece
        base_of, taken = _place(children)
        # From the root down: a child's state is known once its parent's base is.
        end = len(taken) + 257
        base, check, value = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.full(end, -1, np.int32)
        check[0] = 0
        queue = [(0, 0)]
        for node, state in queue:
            value[state], base[state] = ends[node], base_of[node]
            for byte, child in children[node].items():
                check[base_of[node] + byte] = state
                queue.append((child, base_of[node] + byte))
        return Trie(base, check, value)


def _place(children: list[dict[int, int]]) -> tuple[list[int], np.ndarray]:
    """A base for every node with children, so that no two children share a place; nodes with many
    children choose first, and the many with one take what is left."""
    taken = np.zeros(2 * len(children) + 1024, bool)
    taken[0] = True
    bases = [0] * len(children)
    single, low = 257, 1
    for node in sorted(range(len(children)), key=lambda node: -len(children[node])):
        keys = np.array(sorted(children[node]))
        if not len(keys):
            continue
        if len(keys) == 1:
            while taken[single]:
                single += 1
                if single + 1 >= len(taken):
                    taken = np.pad(taken, (0, len(taken)))
            start = single - int(keys[0])
        else:
            at = low
            while True:
                if at + 1024 + 256 >= len(taken):
                    taken = np.pad(taken, (0, len(taken)))
                starts = np.arange(at, at + 1024)
                fits = ~taken[starts[:, None] + keys[None, :]].any(axis=1)
                if fits.any():
                    start = int(starts[np.argmax(fits)])
                    break
                at += 1024
            low = max(low, start - 4096)  # places long passed by are left to single children
        taken[start + keys] = True
        bases[node] = start
    return bases, taken


def zipf(pieces: list[tuple[str, float, str]]) -> list[tuple[str, float, str]]:
    """Ranks as log probabilities proportional to 1 / (rank + 1)."""
    total = sum(1 / (1 - score) for _, score, kind in pieces if kind == "normal")
    return [(piece, -math.log((1 - score) * total), kind) for piece, score, kind in pieces]


@dataclass
class Vocabulary:
    trie: Trie
    scores: np.ndarray
    unknown_score: float
    first_byte: int
    texts: list[bytes]

    def __post_init__(self) -> None:
        self.letters = np.frombuffer(b"".join(self.texts), np.uint8)
        self.lengths = np.array([len(text) for text in self.texts])
        self.starts = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def of(pieces: list[tuple[str, float, str]]) -> Vocabulary:
        """From (piece, log score, kind) by id; kind: normal, byte, or other (never matched)."""
        normal = [(piece.encode(), i) for i, (piece, _, kind) in enumerate(pieces) if kind == "normal"]
        if any(MARK in piece.lstrip(MARK) for piece, _, kind in pieces if kind == "normal"):
            raise ValueError("a piece holds a space marker after another sign: texts cannot be cut before markers")
        scores = np.array([score for _, score, _ in pieces], np.float64)
        least = min((score for _, score, kind in pieces if kind == "normal"), default=0.0)
        first = next(i for i, (_, _, kind) in enumerate(pieces) if kind == "byte")
        texts = [
            piece.replace(MARK, " ").encode() if kind == "normal" else bytes([i - first]) if kind == "byte" else b""
            for i, (piece, _, kind) in enumerate(pieces)
        ]
        return Vocabulary(Trie.build(normal), scores, least - UNKNOWN, first, texts)

    @staticmethod
    def load(path: str = MODEL, ranked: bool = True) -> Vocabulary:
        """From a model file. `ranked`: its scores are merge ranks (0, -1, -2, …) and not yet log
        scores; then a piece of rank r has the log probability that Zipf's law gives rank r + 1."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            return "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"

        pieces = [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())]
        return Vocabulary.of(zipf(pieces) if ranked else pieces)

    def solve(self, parts: list[str]) -> list[bytes]:
        """Best ids of each part, as 32-bit numbers on end. Parts of like length are solved side by side."""
        raw = [part.encode() for part in parts]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        solved = [b""] * len(raw)
        at = 0
        while at < len(order):
            # At most 16,384 parts, and about a million places of the tables.
            end = at + 1
            while end < len(order) and end - at < 16_384 and (end - at) * len(raw[order[end]]) < 1 << 20:
                end += 1
            ids, cuts = self._solve([raw[i] for i in order[at:end]])
            whole, cuts = ids.tobytes(), (4 * cuts).tolist()
            for place, i in enumerate(order[at:end]):
                solved[i] = whole[cuts[place] : cuts[place + 1]]
            at = end
        return solved

    def _solve(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts on end, and where each part begins."""
        trie, scores = self.trie, self.scores
        sizes = np.array([len(part) for part in raw])
        width = int(sizes.max())
        data = np.frombuffer(b"".join(part.ljust(width, b"\0") for part in raw), np.uint8).reshape(len(raw), width)
        inside = np.zeros((len(raw), width + 4), bool)  # bytes within a sign
        inside[:, :width] = (data & 0xC0) == 0x80
        # Tables by place, then part: what is read and written together lies together.
        best = np.full((width + 1, len(raw)), -np.inf)
        best[0] = 0
        back = np.zeros((width + 1, len(raw)), np.int32)
        piece = np.full((width + 1, len(raw)), -1, np.int32)
        columns = np.ascontiguousarray(data.T).astype(np.int32)
        for i in range(width):
            rows = np.flatnonzero((sizes > i) & (best[i] > -np.inf))
            if not len(rows):
                continue
            run = inside[rows, i + 1 : i + 4] if width > 1 else np.zeros((len(rows), 3), bool)
            signs = 1 + np.cumprod(run, axis=1).sum(axis=1)  # bytes of the sign that begins here
            alone = np.zeros(len(rows), bool)
            at, here, state, begun = np.arange(len(rows)), rows, np.zeros(len(rows), np.int32), best[i, rows]
            for j in range(i, width):
                place = trie.base[state] + columns[j, here]
                stays = np.flatnonzero((trie.check[place] == state) & (place > 0) & (sizes[here] > j))
                if not len(stays):
                    break
                at, here, state, begun = at[stays], here[stays], place[stays], begun[stays]
                value = trie.value[state]
                hit = np.flatnonzero(value >= 0)
                if len(hit):
                    found, row = value[hit], here[hit]
                    alone[at[hit][signs[at[hit]] == j + 1 - i]] = True
                    score = begun[hit] + scores[found]
                    more = np.flatnonzero(score > best[j + 1, row])
                    row = row[more]
                    best[j + 1, row], back[j + 1, row], piece[j + 1, row] = score[more], i, found[more]
            lone = rows[~alone]
            if len(lone):
                end = i + signs[~alone]
                score = best[i, lone] + self.unknown_score
                more = score > best[end, lone]
                lone, end = lone[more], end[more]
                best[end, lone], back[end, lone], piece[end, lone] = score[more], i, -1
        # All parts are walked from their ends at once; a sign no piece covers gives a byte at a time.
        row, end = np.arange(len(raw)), sizes.copy()
        rows, ids = [], []
        while len(row):
            found, start = piece[end, row], back[end, row]
            known = found >= 0
            last = data[row, end - 1].astype(np.int32)
            rows.append(row)
            ids.append(np.where(known, found, self.first_byte + last))
            # The rest of an unknown sign: its place's way back stays the sign's start.
            lower = end - 1
            rest = ~known & (lower > start)
            back[lower[rest], row[rest]], piece[lower[rest], row[rest]] = start[rest], -1
            end = np.where(known, start, lower)
            row, end = row[end > 0], end[end > 0]
        rows, ids = np.concatenate(rows)[::-1], np.concatenate(ids)[::-1]
        order = np.argsort(rows, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(raw)))])
        return ids[order].astype(np.int32), cuts

    def encode(self, texts: list[str | None], memory: dict[str, bytes]) -> list[np.ndarray | None]:
        """Ids of each text; `memory` keeps the ids of parts from call to call."""
        cut = [None if text is None else _PARTS.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        if len(memory) > REMEMBERED:
            memory.clear()
        new = list(set(chain.from_iterable(parts for parts in cut if parts)) - memory.keys())
        memory.update(zip(new, self.solve(new)))
        look = memory.__getitem__
        return [None if parts is None else np.frombuffer(b"".join(map(look, parts)), np.int32) for parts in cut]

    def decode_all(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """Pieces on end, bytes as bytes, markers as spaces, without the space put in front."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        whole = self.letters[places].tobytes()
        edges = np.concatenate([[0], ends])[cuts].tolist()
        found = [whole[a:b] for a, b in zip(edges, edges[1:])]
        return [text[1:] if text.startswith(b" ") else text for text in found]

    def decode(self, ids: Iterable[int]) -> str:
        ids = np.array(list(ids), np.int64)
        return self.decode_all(ids, np.array([0, len(ids)]))[0].decode("utf-8", errors="replace")


def encode_documents(documents: DataFrame, vocabulary: Vocabulary, carry: list[str] | None = None) -> DataFrame:
    """Per row the carried columns (doc_id by default), then ids, n_tokens, n_byte_tokens and
    round_trip (whether decoding gives back the text, NULL for NULL). A carried column of one of
    these names is called document_<name>."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    carry = carry or ["doc_id"]
    source = documents.select(*[F.col(name).alias(f"carry_{name}") for name in carry], F.col("text").cast("string").alias("text"))
    added = [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_byte_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType()),
    ]
    schema = T.StructType([*source.drop("text").schema.fields, *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        low, high = vocabulary.first_byte, vocabulary.first_byte + 256
        memory: dict[str, bytes] = {}
        for batch in batches:
            for begin, end in slices(batch["text"]):
                texts = batch["text"].slice(begin, end - begin).to_pylist()
                ids = vocabulary.encode(texts, memory)
                sizes = np.array([0 if own is None else len(own) for own in ids])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.concatenate([own for own in ids if own is not None] or [np.zeros(0, np.int32)])
                back = vocabulary.decode_all(flat, offsets)
                trips = [None if text is None else text.encode() == own for text, own in zip(texts, back)]
                spelled = np.concatenate([[0], np.cumsum((flat >= low) & (flat < high))])
                missing = pa.array([own is None for own in ids])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=missing)
                counted = [pa.array(sizes.astype(np.int64)), pa.array(np.diff(spelled[offsets]).astype(np.int64))]
                carried = [batch[name].slice(begin, end - begin) for name in names[: -len(added)]]
                yield pa.RecordBatch.from_arrays([*carried, lists, *counted, pa.array(trips, pa.bool_())], names)

    encoded = source.mapInArrow(run, schema)
    own = [field.name for field in added]
    carried = [F.col(f"carry_{name}").alias(f"document_{name}" if name in own else name) for name in carry]
    return encoded.select(*carried, *own)
