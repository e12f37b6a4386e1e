"""Toxicity by a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A document is the set of its hashed n-grams of bytes (A-Z lower-cased). Training, on a bounded
sample of labelled documents: Spark counts in how many documents of either label each n-gram
occurs; the log-count ratio r of an n-gram is how much likelier it is under one label. N-grams
with too few documents or too little difference are no features. A logistic regression then learns
weights for features scaled by r. Scoring adds the weights of the features in the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import ragged, remainder, sliced, small_batches, stored, text_buffer
from hirelens.sources.tables import read_parquet

BITS = 22
LENGTHS = (4, 5, 6, 7, 8)
# What a byte counts as: A-Z lower-cased; control characters and ASCII punctuation are spaces, so that
# an n-gram can tell where a word begins or ends.
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[65:91] += 32
LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 32


def ngram_codes(content: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each length the n-gram that begins at each byte, packed into 64 bits; 0 where the text ends before."""
    letters = LETTERS[content].astype(np.uint64)
    code = letters.copy()
    for n in range(2, max(LENGTHS) + 1):
        if len(code) <= 1:
            return
        code = (code[:-1] << np.uint64(8)) | letters[n - 1:]
        if n not in LENGTHS:
            continue
        codes = code.copy()
        ends = offsets[1:, None] - np.arange(1, n)[None, :]
        codes[ends[(ends >= offsets[:-1, None]) & (ends < len(codes))]] = 0
        yield codes


def buckets_of(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)


def found(batch: pa.RecordBatch, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, n-gram) of the n-grams whose buckets are marked in ``wanted``, by row."""
    content, offsets = text_buffer(batch.column("text"))
    rows, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for codes in ngram_codes(content, offsets):
        at = np.flatnonzero(wanted[buckets_of(codes)] & (codes != 0))
        rows.append(np.searchsorted(offsets, at, side="right") - 1)
        kept.append(codes[at])
    rows, kept = np.concatenate(rows), np.concatenate(kept)
    order = np.lexsort((kept, rows))
    rows, kept = rows[order], kept[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (kept[1:] != kept[:-1])][:len(rows)]
    return rows[new], kept[new]


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str,
                    per_label: int) -> DataFrame:
    """Texts, labels (bad boolean) and weights of about ``per_label`` documents a label, at most twice as many.

    A row's weight is how many labelled rows it stands for. The sample follows a hash of the identifier, so it is the
    same at every run. Only its identifiers, bounded by ``per_label``, are broadcast. Of rows that repeat an
    identifier one is taken, by a hash of its text, so the bound holds for rows too.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(
        F.col(label_id).alias("doc_id")).agg(F.max(F.col(label_col) != 0).alias("bad"))
    marked = stored(marked, "toxic-labels")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    sizes = {r.bad: r.n for r in marked.groupBy("bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [marked.where((F.col("bad") == bad) & (draw < per_label / n)).limit(2 * per_label)
             .withColumn("weight", F.lit(max(1.0, n / per_label))) for bad, n in sizes.items()]
    if not parts:
        return docs.select(F.col(text_col).alias("text"), F.lit(True).alias("bad"), F.lit(1.0).alias("weight")).limit(0)
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "bad", "weight").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "bad", "weight")


def bucket_frequencies(sample: DataFrame) -> DataFrame:
    """(bucket, bad, good): documents of either label with each hashed n-gram. Summed in the task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), dtype=np.int32)
        for batch in sliced(batches, "text"):
            content, offsets = text_buffer(batch.column("text"))
            for k, bad in enumerate(batch.column("bad").to_pylist()):
                text = content[offsets[k]:offsets[k + 1]]
                codes = [c for c in ngram_codes(text, np.array([0, len(text)]))]
                if codes:
                    codes = np.concatenate(codes)
                    totals[int(bad)][np.unique(buckets_of(codes[codes != 0]))] += 1
        at = np.flatnonzero(totals.any(axis=0))
        for start in range(0, len(at), 1 << 18):
            part = at[start:start + (1 << 18)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(totals[1][part]), pa.array(totals[0][part])],
                names=["bucket", "bad", "good"])

    counted = sample.mapInArrow(count, "bucket int, bad int, good int")
    return counted.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def ngram_frequencies(sample: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(code, bad, good): documents of either label with each n-gram in the wanted buckets."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows, codes = found(batch, wanted)
            bad = np.asarray(batch.column("bad").to_pylist(), dtype=bool)[rows]
            codes, place = np.unique(codes, return_inverse=True)
            sums = [np.bincount(place[bad == b], minlength=len(codes)) for b in (True, False)]
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), *map(pa.array, sums)],
                                             names=["code", "bad", "good"])

    counted = sample.mapInArrow(count, "code long, bad long, good long")
    return counted.groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def difference(n_bad: int, n_good: int) -> tuple[Column, Column]:
    """Add-one log-count ratio of an n-gram, and its labels' difference in standard errors."""
    p, q = (F.col("bad") + 1) / F.lit(n_bad + 2.0), (F.col("good") + 1) / F.lit(n_good + 2.0)
    pool = (F.col("bad") + F.col("good") + 1) / F.lit(n_bad + n_good + 2.0)
    return F.log(p / q), F.abs(p - q) / F.sqrt(pool * (1 - pool) * (1 / n_bad + 1 / n_good))


class Model:
    """N-grams with their weights (already scaled by the log-count ratio) and the intercept."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, intercept: float):
        order = np.argsort(codes)
        self.codes, self.weights, self.intercept = codes[order], weights[order], intercept
        self.wanted = np.zeros(1 << BITS, dtype=bool)
        self.wanted[buckets_of(self.codes)] = True

    def place(self, codes: np.ndarray) -> np.ndarray:
        """Position of each n-gram among the features, -1 if it is none."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        rows, codes = found(batch, self.wanted)
        at = self.place(codes)
        total = np.bincount(rows[at >= 0], weights=self.weights[at[at >= 0]], minlength=batch.num_rows)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -60, 60)))


def fit_logistic(rows: np.ndarray, features: np.ndarray, values: np.ndarray, bad: np.ndarray, weight: np.ndarray,
                 n_features: int, l2: float = 0.01, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic regression by accelerated gradient steps."""
    n = len(bad)
    share = weight / weight.sum()
    rate = share[bad].sum()
    weights, intercept = np.zeros(n_features), float(np.log(rate / (1 - rate)))
    look, look_b, t = weights.copy(), intercept, 1.0
    norms = np.bincount(rows, weights=values ** 2, minlength=n) + 1
    step = 4 / (norms.max() + 4 * l2 / n)
    for _ in range(steps):
        z = np.bincount(rows, weights=values * look[features], minlength=n) + look_b
        error = share * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - bad)
        new = look - step * (np.bincount(features, weights=values * error[rows], minlength=n_features) + l2 / n * look)
        new_b = look_b - step * error.sum()
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / following * (new - weights)
        look_b = new_b + (t - 1) / following * (new_b - intercept)
        weights, intercept, t = new, new_b, following
    return weights, float(intercept)


def train(sample: DataFrame, least_documents: int = 5, significance: float = 4.0, features: int = 1 << 14) -> Model:
    """Fit on a bounded sample (text, bad, weight). Without both labels the model scores every text alike.

    Features are n-grams in at least ``least_documents`` texts whose shares under the two labels
    differ by ``significance`` standard errors; at most ``features`` of them, the clearest ones.
    Hashed counts tell first which buckets can hold such n-grams; only those are counted exactly.
    """
    kept = stored(sample, "toxic-sample")
    sizes = {r.bad: r.n for r in kept.groupBy("bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 5.0 if sizes.get(True) else -5.0)
    ratio, tells = difference(sizes[True], sizes[False])
    enough = F.col("bad") + F.col("good") >= least_documents
    promising = bucket_frequencies(kept).where(enough & (tells >= significance / 2)).select("bucket").toPandas()
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[promising["bucket"].to_numpy()] = True
    best = (ngram_frequencies(kept, wanted).where(enough & (tells >= significance))
            .select("code", ratio.alias("ratio"), tells.alias("tells"))
            .orderBy(F.desc("tells"), "code").limit(features).toPandas())
    codes = best["code"].to_numpy(np.int64).view(np.uint64)
    scaled = Model(codes, best["ratio"].to_numpy(float), 0.0)

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows, held = found(batch, scaled.wanted)
            at = scaled.place(held)
            rows, at = rows[at >= 0], at[at >= 0]
            cuts = np.searchsorted(rows, np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bad"), batch.column("weight"), ragged(np.split(at, cuts), pa.int32())],
                names=["bad", "weight", "features"])

    held = kept.mapInArrow(active, "bad boolean, weight double, features array<int>").toPandas()
    rows = np.repeat(np.arange(len(held)), held["features"].map(len))
    at = np.concatenate([np.zeros(0, np.int64), *held["features"]]).astype(np.int64)
    weights, intercept = fit_logistic(rows, at, scaled.weights[at], held["bad"].to_numpy(bool),
                                      held["weight"].to_numpy(float), len(codes))
    return Model(scaled.codes, weights * scaled.weights, intercept)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted. Null and empty texts get the score of a text without features.

    Identifiers are handed through, null or repeated; other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            score = shared.value.score(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from labels of the rows that are not held out."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet")
    held_out: Column = remainder("doc_id", 4) == 2
    sample = labelled_sample(docs, labels.where(~held_out), "doc_id", "text", "doc_id", "toxic", per_label=3000)
    return score_texts(docs, train(sample)).withColumn("held_out", held_out)
