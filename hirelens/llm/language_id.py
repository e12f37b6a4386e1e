"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of consecutive bytes, every byte in exactly one window. In each window
one gated recurrent layer reads forwards, another backwards; from both states every position gets
language probabilities. A document's probabilities are the mean over all its positions. The
network is trained in numpy by backpropagation through time on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import remainder, sliced, small_batches, text_buffer
from hirelens.sources.tables import read_parquet

WINDOW = 96
HIDDEN = 8
# Windows advanced together; bounds a task's memory and keeps the state in the processor's cache.
AT_ONCE = 4096
UNKNOWN = "und"


def windows(content: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: bytes (width x windows), their lengths, and the text of each."""
    sizes = np.diff(offsets)
    many = -(-sizes // width)
    rows = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
    starts = offsets[rows] + number * width
    lengths = np.minimum(sizes[rows] - number * width, width)
    places = starts[None, :] + np.arange(width)[:, None]
    letters = content[np.minimum(places, max(len(content) - 1, 0))] if len(content) else np.zeros(places.shape, np.uint8)
    return letters, lengths, rows


@dataclass
class Network:
    """Weights of both directions: input rows per byte, recurrent matrices, and the output layer.

    Gates: z (how much of the state is replaced) and r (how much of it the candidate sees).
    """

    languages: list[str]
    given: np.ndarray      # 2 x 256 x 3H
    gates: np.ndarray      # 2 x H x 2H
    fresh: np.ndarray      # 2 x H x H
    out: np.ndarray        # 2H x L
    bias: np.ndarray       # L

    @classmethod
    def start(cls, languages: list[str], seed: int = 1) -> "Network":
        draw, h = np.random.default_rng(seed), HIDDEN
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        net = cls(languages, normal(2, 256, 3 * h, scale=0.3), normal(2, h, 2 * h, scale=h ** -0.5),
                  normal(2, h, h, scale=h ** -0.5), normal(2 * h, len(languages), scale=0.3),
                  np.zeros(len(languages), np.float32))
        net.given[:, :, :h] -= 1.0  # states last at first
        return net

    def parts(self) -> list[np.ndarray]:
        return [self.given, self.gates, self.fresh, self.out, self.bias]

    def states(self, letters: np.ndarray, keep: bool = False):
        """States after each position, both directions (width x 2 x windows x H); the backward one from the end.

        A short window's padding comes after its bytes: the forward state there is not used, the
        backward layer has read it first, as it has in training.
        """
        width, n = letters.shape
        h = HIDDEN
        all_states = np.empty((width, 2, n, h), np.float32)
        state = np.zeros((2, n, h), np.float32)
        trace = []
        given = np.empty((2, n, 3 * h), np.float32)
        for t in range(width):
            np.take(self.given[0], letters[t], axis=0, out=given[0])
            np.take(self.given[1], letters[width - 1 - t], axis=0, out=given[1])
            gate = state @ self.gates
            gate += given[:, :, :2 * h]
            sigmoid(gate)
            z, r = gate[:, :, :h], gate[:, :, h:]
            seen = r * state
            candidate = seen @ self.fresh
            candidate += given[:, :, 2 * h:]
            np.tanh(candidate, out=candidate)
            if keep:
                trace.append((state, z.copy(), r.copy(), seen, candidate))
            moved = candidate - state
            moved *= z
            state = np.add(state, moved, out=all_states[t])
        return (all_states, trace) if keep else all_states

    def positions(self, all_states: np.ndarray) -> np.ndarray:
        """Language probabilities of every position (width x windows x L)."""
        h = HIDDEN
        score = all_states[:, 0] @ self.out[:h]
        score += all_states[::-1, 1] @ self.out[h:]
        score += self.bias
        score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=2, keepdims=True)
        return score


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; tanh is the fast way in numpy."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def gradients(net: Network, letters: np.ndarray, lengths: np.ndarray, targets: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions and its gradients, by backpropagation through time."""
    width, n = letters.shape
    h = HIDDEN
    all_states, trace = net.states(letters, keep=True)
    there = (np.arange(width)[:, None] < lengths[None, :])
    share = (there / there.sum()).astype(np.float32)
    p = net.positions(all_states)
    loss = -float((np.log(np.maximum(p[:, np.arange(n), targets], 1e-9)) * share).sum())
    p[:, np.arange(n), targets] -= 1
    p *= share[:, :, None]
    both = np.concatenate([all_states[:, 0], all_states[::-1, 1]], axis=2)
    d_out = np.tensordot(both, p, axes=([0, 1], [0, 1]))
    d_bias = p.sum(axis=(0, 1))
    back = p @ net.out.T
    d_all = np.stack([back[:, :, :h], back[::-1, :, h:]], axis=1)
    d_given, d_gates, d_fresh = np.zeros_like(net.given), np.zeros_like(net.gates), np.zeros_like(net.fresh)
    d_state = np.zeros((2, n, h), np.float32)
    for t in range(width - 1, -1, -1):
        state, z, r, seen, candidate = trace[t]
        d_state = d_state + d_all[t]
        d_z = d_state * (candidate - state) * z * (1 - z)
        d_c = d_state * z * (1 - candidate ** 2)
        d_seen = d_c @ net.fresh.transpose(0, 2, 1)
        d_r = d_seen * state * r * (1 - r)
        d_gate = np.concatenate([d_z, d_r], axis=2)
        d_gates += state.transpose(0, 2, 1) @ d_gate
        d_fresh += seen.transpose(0, 2, 1) @ d_c
        d_input = np.concatenate([d_gate, d_c], axis=2)
        for way, at in ((0, t), (1, width - 1 - t)):
            order = np.argsort(letters[at], kind="stable")
            sorted_letters = letters[at][order]
            begins = np.flatnonzero(np.r_[True, sorted_letters[1:] != sorted_letters[:-1]])
            d_given[way][sorted_letters[begins]] += np.add.reduceat(d_input[way][order], begins, axis=0)
        d_state = d_state * (1 - z) + d_seen * r + d_gate @ net.gates.transpose(0, 2, 1)
    return loss, [d_given, d_gates, d_fresh, d_out, d_bias]


def train(texts: list[bytes], labels: list[str], steps: int = 400, at_once: int = 256, rate: float = 0.02,
          seed: int = 1) -> Network | None:
    """Fit by Adam on random windows of the given texts, languages drawn equally often. None without texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    net, draw = Network.start(languages, seed), np.random.default_rng(seed)
    if len(languages) == 1:
        return net
    by_language = [[t for t, name in zip(texts, labels) if name == language] for language in languages]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    for step in range(1, steps + 1):
        targets = draw.integers(len(languages), size=at_once)
        letters, lengths = np.full((WINDOW, at_once), 32, np.uint8), np.zeros(at_once, np.int64)
        for k, target in enumerate(targets):
            text = by_language[target][draw.integers(len(by_language[target]))]
            start = draw.integers(max(len(text) - WINDOW, 0) + 1)
            part = np.frombuffer(text[start:start + WINDOW], np.uint8)
            letters[:len(part), k], lengths[k] = part, len(part)
        _, found = gradients(net, letters, lengths, targets)
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in found))
        pace = rate * min(1.0, 4 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for weights, (mean, square), g in zip(net.parts(), moments, found):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            weights -= (pace * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
    return net


def document_scores(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean probabilities over all positions of each text (rows x languages); zeros for an empty text."""
    content, offsets = text_buffer(texts)
    total = np.zeros((len(texts), len(net.languages)))
    letters, lengths, rows = windows(content, offsets)
    for start in range(0, letters.shape[1], AT_ONCE):
        part = slice(start, start + AT_ONCE)
        seen = np.arange(WINDOW)[:, None] < lengths[None, part]
        letter = np.where(seen, letters[:, part], 32).astype(np.uint8)
        p = net.positions(net.states(letter))
        p *= seen[:, :, None]
        np.add.at(total, rows[part], p.sum(axis=0))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def labelled_sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int,
                    excerpt: int) -> list[tuple[str, str]]:
    """(language, excerpt) of at most ``per_language`` rows of each language, those with the smallest hashes.

    The hash is of identifier and text, so null or repeated identifiers draw like others; rows equal in
    both count once. The excerpt starts at a hashed place of the text, so training sees all parts of texts.
    """
    draw = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"))
    named = known.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"))
    share = F.pmod("draw", F.lit(1 << 30)) / (1 << 30)
    wanted = None
    for lang, n in sorted((r.lang, r.n) for r in named.collect()):
        # Twice the rows wanted, as their number is only about known.
        part = (F.col("lang") == lang) & (share < 2 * per_language / max(n, 1))
        wanted = part if wanted is None else wanted | part
    if wanted is None:
        return []
    begin = F.pmod(F.xxhash64("draw", F.lit(7)), F.greatest(F.length("text") - excerpt, F.lit(0)) + 1)
    shown = known.where(wanted).select(
        "lang", share.alias("share"), "draw", F.substring("text", begin.cast("int") + 1, F.lit(excerpt)).alias("text"))
    once = shown.groupBy("lang", "share", "draw").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("share", "draw"))
    rows = once.withColumn("place", place).where(F.col("place") <= per_language).collect()
    return sorted((r.lang, r.text) for r in rows)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = 1500, excerpt: int = 600) -> Network | None:
    """A network trained on a bounded sample of the labelled rows of ``docs``; None if there are none."""
    rows = labelled_sample(docs, text_col, lang_col, id_col, per_language, excerpt)
    return train([t.encode() for _, t in rows], [lang for lang, _ in rows])


def identify(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, all other columns unchanged, without a shuffle.

    Only the text is read for a prediction. Null texts and texts without a letter, and all texts if
    there is no network, are ``und`` with score 0. A column that is already called lang_pred or
    score is replaced.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    narrow = docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("text"), has_letter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in sliced(batches, "text", 4 << 20):
            names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            at = np.flatnonzero(np.asarray(batch.column("has_letter").to_pylist(), dtype=bool))
            if net is not None and len(at):
                found = document_scores(net, batch.column("text").take(pa.array(at)))
                best = found.argmax(axis=1)
                score[at] = np.clip(found[np.arange(len(at)), best], 0, 1)
                for k, b in zip(at, best):
                    names[k] = net.languages[b]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["row", "lang_pred", "score"])

    schema = narrow.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return narrow.mapInArrow(run, schema).select("row.*", "lang_pred", "score")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from the rows that are not held out."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    held_out: Column = remainder("doc_id", 3) == 1
    net = learn(docs.where(~held_out))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
