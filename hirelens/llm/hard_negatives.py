"""Hard negatives by exact inner products, scored by table look-ups (the method of the Four Russians).

The components of an anchor are cut into groups of eight. For each group the sums of all 256 subsets
are computed once. A candidate's components are stood on end: each binary digit of eight components
is one byte, which names a subset. So a digit's share of the inner product is one look-up a group,
and the digits are put together by shift and add. All is integer arithmetic: scores are exact.

Anchors are the stated query set. They go to the tasks in parts of bounded size, every part meets
every row, and a task keeps the few best rows of each anchor, never the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.llm.common import stored
from hirelens.sources.tables import read_parquet

# Anchors that are with the tasks at a time; more anchors take more passes over the rows.
ANCHORS_AT_ONCE = 1 << 16
# Rows and anchors of one block of scores.
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 64
# Components must stay below this size, so that scores times 100 fit 64 bits.
LARGEST = 1 << 24
GROUP = 8


def padded(column: pa.Array) -> np.ndarray:
    """Lists of integers as one array, a row each; short lists end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy().astype(np.int64))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, subset, anchor]: for every eight components, the sums of all their subsets (bit j: component j)."""
    count, width = anchors.shape
    groups = -(-width // GROUP)
    parts = np.zeros((groups, GROUP, count), dtype=np.int64)
    parts.reshape(groups * GROUP, count)[:width] = anchors.T
    sums = np.zeros((groups, 1, count), dtype=np.int64)
    for k in range(GROUP):
        sums = np.concatenate([sums, sums + parts[:, k:k + 1]], axis=1)
    return sums


def bit_planes(vectors: np.ndarray, width: int) -> np.ndarray:
    """[digit, row, group]: two's complement digits of the first ``width`` components, eight to a byte.

    The last digit carries the sign. Missing components are zeros.
    """
    used = np.zeros((len(vectors), -(-width // GROUP) * GROUP), dtype=np.int64)
    shared = min(width, vectors.shape[1])
    used[:, :shared] = vectors[:, :shared]
    digits = int(np.abs(used).max(initial=0)).bit_length() + 1
    return np.stack([np.packbits((used >> k) & 1 == 1, axis=1, bitorder="little") for k in range(digits)])


def score(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, [row, anchor]: a look-up for each digit and group, from the sign digit down, doubled in between."""
    digits, rows, groups = planes.shape
    bound = int(np.abs(sums).max(axis=1, initial=0).sum(axis=0).max(initial=0)) << digits
    sums = sums.astype(np.int32) if bound < 1 << 31 else sums
    total = np.zeros((rows, sums.shape[2]), dtype=sums.dtype)
    found = np.empty_like(total)
    for k in range(digits - 1, -1, -1):
        total += total
        for g in range(groups):
            np.take(sums[g], planes[k, :, g], axis=0, out=found)
            if k == digits - 1:
                total -= found
            else:
                total += found
    return total


class Best:
    """The few best rows of each slot: higher scores first, ties by the smaller identifier."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot, self.score, self.row = (np.zeros(0, dtype=np.int64) for _ in range(3))
        # A score below this can't enter a slot.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def offer(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        good = score >= self.least[slot]
        slot, score, row = (np.concatenate([a, b[good]]) for a, b in (
            (self.slot, slot), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, slot))
        slot, score, row = slot[order], score[order], row[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, dtype=np.int64)
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        keep = place < self.size
        self.slot, self.score, self.row, place = slot[keep], score[keep], row[keep], place[keep]
        full = place == self.size - 1
        self.least[self.slot[full]] = self.score[full]


class Anchors:
    """One part of the anchors, ordered by label, as the tasks see it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]

    def blocks(self) -> Iterator[slice]:
        for start in range(0, len(self.ids), BLOCK_ANCHORS):
            yield slice(start, min(start + BLOCK_ANCHORS, len(self.ids)))


def positives_of(anchors: Anchors, best: Best, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    """Offer rows of each anchor's own label, but for the anchor itself."""
    order = np.argsort(labels, kind="stable")
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    for block in anchors.blocks():
        own = anchors.labels[block]
        sums = None
        first, last = np.searchsorted(labels, own[0]), np.searchsorted(labels, own[-1], side="right")
        for start in range(first, last, BLOCK_ROWS):
            rows = slice(start, min(start + BLOCK_ROWS, last))
            sums = subset_sums(anchors.vectors[block]) if sums is None else sums
            scores = score(sums, bit_planes(vectors[rows], anchors.vectors.shape[1]))
            fits = (labels[rows][:, None] == own) & (ids[rows][:, None] != anchors.ids[block])
            fits &= scores >= best.least[block]
            row, column = np.nonzero(fits)
            best.offer(block.start + column, scores[row, column].astype(np.int64), ids[rows][row])


def negatives_of(anchors: Anchors, low: np.ndarray, high: np.ndarray, best: Best,
                 ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    """Offer rows of other labels whose score lies between the bounds of a slot; ``low`` and ``high`` are [anchor, slot]."""
    slots = low.shape[1]
    for block in anchors.blocks():
        sums = subset_sums(anchors.vectors[block])
        for start in range(0, len(ids), BLOCK_ROWS):
            rows = slice(start, min(start + BLOCK_ROWS, len(ids)))
            scores = score(sums, bit_planes(vectors[rows], anchors.vectors.shape[1]))
            least = np.maximum(low[block], best.least.reshape(low.shape)[block])
            fits = (scores >= least.min(axis=1)) & (scores <= high[block].max(axis=1))
            row, column = np.nonzero(fits & (labels[rows][:, None] != anchors.labels[block]))
            found = scores[row, column].astype(np.int64)
            for k in range(slots):
                good = (found >= least[column, k]) & (found <= high[block][column, k])
                best.offer((block.start + column[good]) * slots + k, found[good], ids[rows][row[good]])


def best_rows(rows: DataFrame, slots: int, size: int, offer) -> DataFrame:
    """(slot, score, row): the ``size`` best rows of every slot over all tasks; ``offer(best, ids, labels, vectors)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(slots, size)
        for batch in batches:
            offer(best, batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), padded(batch.column("vector")))
        yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.score), pa.array(best.row)],
                                         names=["slot", "score", "row"])

    found = rows.mapInArrow(run, "slot long, score long, row long")
    # A slot has at most ``size`` rows from every task.
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, vector of longs) of the rows that take part."""
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).cast("array<bigint>").alias("vector"))
    whole = F.forall("vector", lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))
    return named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
         anchors_at_once: int = ANCHORS_AT_ONCE) -> DataFrame:
    """Hard negatives of integer vectors: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its best rows of the same label and another identifier; a positive's
    negatives the best rows of other labels with low * p <= 100 * n <= high * p. ``is_anchor`` is a
    condition on the column vec_id.

    Rows with a null identifier, label, vector or component, or a component of 2^24 or more, take no
    part. Short vectors end in zeros. Equal scores come in the order of identifiers. Repeated rows are
    rows of their own as positives and negatives, but one anchor; rows that share an identifier and
    differ are several anchors. Anchors without positives or fitting negatives give no row. Further
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, label_col, vector_col)
    asked = stored(rows.where(is_anchor).distinct(), "hard-negative-anchors")
    parts = -(-asked.count() // anchors_at_once)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    results = [_mine_part(rows, asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == k), positives, negatives, low, high)
               for k in range(parts)]
    out = spark.createDataFrame([], schema)
    for part in results:
        # Several parts: each is written by itself, so that no plan holds them all.
        out = out.unionByName(part if parts == 1 else stored(part, "hard-negatives"))
    return out


def _mine_part(rows: DataFrame, asked: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    context = rows.sparkSession.sparkContext
    table = asked.toArrow()
    anchors = Anchors(table["vec_id"].to_numpy(), table["label"].to_numpy(), padded(table["vector"]))
    shared = context.broadcast(anchors)
    count = len(anchors.ids)

    best = best_rows(rows, count, positives, lambda best, *batch: positives_of(shared.value, best, *batch)).toArrow()
    slot, rank = best["slot"].to_numpy(), best["rank"].to_numpy() - 1
    points, partner = (np.zeros((count, positives), dtype=np.int64) for _ in range(2))
    points[slot, rank], partner[slot, rank] = best["score"].to_numpy(), best["row"].to_numpy()
    # 100 n >= low p and 100 n <= high p, rounded to whole scores; a slot without a positive has no room.
    least, most = -((-low * points) // 100), (high * points) // 100
    empty = np.ones_like(points, dtype=bool)
    empty[slot, rank] = False
    least[empty], most[empty] = 1, 0
    bounds = context.broadcast((least, most))

    def offer(best: Best, *batch) -> None:
        negatives_of(shared.value, *bounds.value, best, *batch)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("slot").to_numpy()
            anchor, at = place // positives, place % positives
            ids, pairs, scores = described.value
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[anchor]), pa.array(pairs[anchor, at]), batch.column("rank"), batch.column("row"),
                 pa.array(scores[anchor, at]), batch.column("score")],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    described = context.broadcast((anchors.ids, partner, points))
    found = best_rows(rows, count * positives, negatives, offer)
    return found.mapInArrow(
        named, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector of ``embeddings``, components in 256ths, some labels moved on."""
    table = read_parquet(spark, f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # NaN and infinities become null, so their rows take no part.
    scaled = F.transform("embedding", lambda x: F.when(
        F.abs(x.cast("double")) < LARGEST, F.floor(256 * x.cast("double")).cast("long")))
    return mine(table.select("vec_id", moved.alias("label"), scaled.alias("vector")), F.col("vec_id") % 100 == 0)


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id,
         CAST(list_sum(list_transform(list_zip(a.vector, o.vector), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
