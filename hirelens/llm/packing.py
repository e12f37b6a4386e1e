"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Pieces are packed longest first, each into the tightest open sequence that holds it, found by a
segment tree over the remaining capacities. Pieces of equal length are alike, so the packing needs
only their number: as long as it takes pieces of one length, the tightest sequence is filled to its
floor before the next, and all sequences with the same history share one entry of the tree. A
histogram of the lengths (at most ``capacity`` rows, however large the corpus) thus gives the same
sequences as one pass over all documents. The plan says where the n-th piece of each length goes.

Spark numbers the pieces of each length: tasks count their own, a window over (length, task) adds
what the tasks before have. No piece passes through the driver, and a frequent length is no hot key.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.llm.common import sliced, small_batches, stored
from hirelens.llm.token_counts import byte_letters
from hirelens.sources.tables import read_parquet

CAPACITY = 2048
# Ends every document.
SEPARATOR = 0
# Pieces handed on at once.
PIECES_AT_ONCE = 4096
# Bits for the rank of a piece among those of its length, beside the length in one number.
RANK_BITS = 44


@dataclass(frozen=True)
class Encoder:
    """A byte-level BPE file as ranks and special strings, from which a task builds its encoder.

    The compiled encoder is several times as fast as the file's own library and gives the same ids,
    provided that ids follow the order of the merges, which is checked.
    """

    pattern: str
    ranks: dict[bytes, int]
    specials: dict[str, int]

    @classmethod
    def load(cls, path: str, pattern: str = public_tokenizers.PATTERN) -> "Encoder":
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, specials = content["model"]["vocab"], {t["content"]: t["id"] for t in content["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        order = [ids[a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError(f"ids of {path} do not follow the order of its merges")
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        return cls(pattern, {bytes(byte_of[x] for x in piece): i for piece, i in ids.items() if piece not in specials}, specials)

    def build(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=self.specials)


def cut(docs: DataFrame, encoder: Encoder, capacity: int = CAPACITY, key: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenised documents in pieces: key, piece, start, length, ids (little-endian unsigned 32-bit), task, nth.

    A document is the ids of its text and one separator. One of more than ``capacity`` ids is cut so
    that all pieces but the first are full. ``key`` is its identifier unless given. ``nth`` counts
    the pieces of one length in one task. Null and empty texts are one separator. Repeated rows and
    identifiers are documents of their own; further columns are not read.
    """
    if not 1 <= capacity < 1 << (63 - RANK_BITS):
        raise ValueError(f"capacity {capacity}")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(encoder)
    named = docs.select((F.col(id_col) if key is None else key).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, task = shared.value.build(), TaskContext.get().partitionId()
        end = np.array([SEPARATOR], dtype=np.uint32)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in sliced(batches, "text"):
            parts = []
            for text in batch.column("text").to_pylist():
                parts += [encoding.encode_to_numpy(text, allowed_special="all"), end] if text else [end[:0], end]
            sizes = np.fromiter(map(len, parts[::2]), np.int64, batch.num_rows) + 1
            ids = np.concatenate(parts).astype("<u4", copy=False) if parts else end[:0]
            counts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            head = sizes - (counts - 1) * capacity
            length = np.where(piece == 0, head[doc], capacity)
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            bounds = np.r_[0, np.cumsum(length)] * 4
            content = ids.view(np.uint8)
            for at in range(0, len(doc), PIECES_AT_ONCE):
                rows = slice(at, min(at + PIECES_AT_ONCE, len(doc)))
                first, last = bounds[at], bounds[rows.stop]
                places = (bounds[at:rows.stop + 1] - first).astype(np.int32)
                binary = pa.BinaryArray.from_buffers(
                    pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(content[first:last])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(doc[rows])), pa.array(piece[rows].astype(np.int32)),
                     pa.array(start[rows]), pa.array(length[rows]), binary,
                     pa.array(np.full(len(places) - 1, task, dtype=np.int64)), pa.array(count_up(length[rows], seen))],
                    names=["key", "piece", "start", "length", "ids", "task", "nth"])

    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids binary, task long, nth long")


def count_up(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How often each value came before, in this array and by ``seen``, which is carried on."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[starts, len(ordered)])
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.arange(len(values)) - np.repeat(starts - seen[ordered[starts]], sizes)
    seen[ordered[starts]] += sizes
    return out


class OpenSequences:
    """Open sequences by remaining capacity, under a segment tree that knows which capacities occur.

    Sequences of one capacity are ranges of numbers: (first, count).
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.occurs = [False] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def tightest(self, length: int) -> int:
        """The smallest remaining capacity of at least ``length``; 0 if no open sequence has it."""
        node = self.leaves + length
        if self.occurs[node]:
            return length
        # Up to the first subtree on the right that has any, then down on its left side.
        while not (node % 2 == 0 and self.occurs[node + 1]):
            node //= 2
            if node <= 1:
                return 0
        node += 1
        while node < self.leaves:
            node = 2 * node if self.occurs[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, remaining: int, first: int, count: int) -> None:
        if remaining and count:
            heapq.heappush(self.ranges[remaining], (first, count))
            self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        taken = heapq.heappop(self.ranges[remaining])
        self._mark(remaining)
        return taken

    def _mark(self, remaining: int) -> None:
        node, held = self.leaves + remaining, bool(self.ranges[remaining])
        while node and self.occurs[node] != held:
            self.occurs[node] = held
            node //= 2
            held = self.occurs[2 * node] or self.occurs[2 * node + 1]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go, as parallel arrays ordered by ``key`` = length and first rank.

    From that rank on, every ``each`` pieces share a sequence, the first of them ``sequence``, from
    ``offset`` on. The size of a plan depends on the capacity, not on the number of pieces: a piece
    less than halves the room of the sequences it meets, and a length splits at most two ranges.
    """

    key: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << RANK_BITS) | rank, side="right") - 1
        behind = rank - self.rank[at]
        return self.sequence[at] + behind // self.each[at], self.offset[at] + behind % self.each[at] * length


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing of ``counts[length]`` pieces of each length (1 to ``capacity``)."""
    rows, opened, open_ = [], 0, OpenSequences(capacity)
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, sequences: int, each: int, room: int) -> None:
            nonlocal left, rank
            rows.append((length << RANK_BITS | rank, rank, each, first, capacity - room))
            open_.put(room - each * length, first, sequences)
            left, rank = left - each * sequences, rank + each * sequences

        while left:
            room = open_.tightest(length)
            if room:
                first, count = open_.take(room)
            else:
                room = capacity
                first, count = opened, -(-left // (capacity // length))
                opened += count
            each = room // length
            full = min(count, left // each)
            if full:
                fill(first, full, each, room)
            if left and full < count:
                fill(first + full, 1, left, room)
                full += 1
            open_.put(room, first + full, count - full)
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=opened)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces, as ``cut`` gives them, with sequence_id (from 0, none left out) and offset instead of task and nth.

    They are written once, so that numbers and results see the same rows. An empty table gives none.
    """
    kept = stored(pieces, "packing-pieces")
    counted = stored(kept.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = best_fit({r.length: r.n for r in histogram}, capacity)
    shared = kept.sparkSession.sparkContext.broadcast(plan)
    # Rows of a length: one a task.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = kept.join(firsts, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    shown = [c for c in pieces.columns if c not in ("task", "nth")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in shown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*map(batch.column, shown), pa.array(sequence), pa.array(offset)],
                                             names=[*shown, "sequence_id", "offset"])

    return ranked.select(*shown, "rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of every sequence, its pieces in order; no sequence exceeds the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda whole, x: F.concat(whole, x["ids"])).alias("ids"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens: where each piece lies, and a digest of its ids."""
    encoder = Encoder.load(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = cut(read_parquet(spark, f"{sf_dir}/documents.parquet"), encoder)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).withColumnRenamed("key", "doc_id").drop("ids")
    return place(digests).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
