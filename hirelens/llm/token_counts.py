"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens; those not counted before in the task lie behind each other in one
numpy array. In each round every sequence applies its lowest-ranked pair at once (all its
non-overlapping places), until no sequence has a pair left. What survives is counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import as_binary, sliced, small_batches
from hirelens.sources.tables import read_parquet

NONE = np.int32(2**31 - 1)
# Pre-tokens remembered by one task; the memory starts anew beyond it.
REMEMBERED = 500_000


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class PairTable:
    """Rank and result of a pair of symbols: open addressing in numpy arrays."""

    BITS = 18

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.BITS, NONE, dtype=np.int32)
        self.merged = merged.astype(np.int32)
        waiting = np.arange(len(left))
        keys, place = self._key(left, right), None
        place = self._home(keys)
        while len(waiting):
            free = self.keys[place[waiting]] == -1
            first = np.unique(place[waiting][free], return_index=True)[1]
            put = waiting[free][first]
            self.keys[place[put]], self.ranks[place[put]] = keys[put], put
            waiting = np.setdiff1d(waiting, put, assume_unique=True)
            place[waiting] = (place[waiting] + 1) & ((1 << self.BITS) - 1)

    @staticmethod
    def _key(left, right) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE if it never merges."""
        keys = self._key(left, right)
        place = self._home(keys)
        found = self.ranks[place]
        there = self.keys[place]
        found[there != keys] = NONE
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & ((1 << self.BITS) - 1)
            there = self.keys[place[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.ranks[place[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return found


@dataclass(frozen=True)
class Vocabulary:
    """What a byte-level BPE file says: symbols of the bytes, the pairs in order, special strings."""

    byte_ids: np.ndarray
    pairs: PairTable
    specials: tuple[str, ...]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        letters = byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        left, right, merged = (np.array(x) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges)))
        return cls(np.array([ids[x] for x in letters], dtype=np.int32), PairTable(left, right, merged),
                   tuple(t["content"] for t in content["added_tokens"] if t["special"]))


def merged_counts(words: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Symbols left of each word after all merges."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    counts = lengths.copy()
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    rows = np.repeat(np.arange(len(words)), lengths)
    pairs = vocabulary.pairs
    ranks = _pair_ranks(symbols, rows, pairs)
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        lowest = np.minimum.reduceat(ranks, starts)
        counts[rows[starts]] = sizes
        going = lowest != NONE
        if not going.all():
            stay = np.repeat(going, sizes)
            symbols, rows, ranks = symbols[stay], rows[stay], ranks[stay]
            sizes, lowest = sizes[going], lowest[going]
            if not len(symbols):
                break
        chosen = ranks == np.repeat(lowest, sizes)
        # Places of one pair that overlap ("aaa") come in runs: every other place merges, from the left.
        begins = chosen & ~np.r_[False, chosen[:-1] & (rows[1:] == rows[:-1])]
        place = np.arange(len(chosen))
        origin = np.maximum.accumulate(np.where(begins, place, 0))
        chosen &= (place - origin) % 2 == 0
        at = np.flatnonzero(chosen)
        symbols[at] = pairs.merged[ranks[at]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        moved = np.cumsum(keep) - 1
        symbols, rows, ranks = symbols[keep], rows[keep], ranks[keep]
        at = moved[at]
        changed = np.union1d(at, at[at > 0] - 1)
        ranks[changed] = _ranks_at(changed, symbols, rows, pairs)
    return counts


def _pair_ranks(symbols, rows, pairs) -> np.ndarray:
    return _ranks_at(np.arange(len(symbols)), symbols, rows, pairs)


def _ranks_at(places, symbols, rows, pairs) -> np.ndarray:
    """Rank of the pair that begins at each place; none at the end of a row."""
    following = np.minimum(places + 1, len(symbols) - 1)
    found = pairs.find(symbols[places], symbols[following])
    found[(rows[places] != rows[following]) | (following == places)] = NONE
    return found


class Counter:
    """Counts the tokens of texts; remembers pre-tokens it has seen."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern, self.known = vocabulary, regex.compile(pattern), {}
        specials = "|".join(regex.escape(s) for s in sorted(vocabulary.specials, key=len, reverse=True))
        self.special = regex.compile(specials) if specials else None

    def __call__(self, texts: list[str]) -> list[int]:
        words, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            extra.append(len(parts) - 1)
            words.append(self.pattern.findall(text) if len(parts) == 1
                         else [w for part in parts for w in self.pattern.findall(part)])
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*words) - self.known.keys())
        if new:
            counts = merged_counts([w.encode() for w in new], self.vocabulary)
            self.known.update(zip(new, counts.tolist()))
        return [sum(map(self.known.__getitem__, w)) + x for w, x in zip(words, extra)]


def count_tokens(docs: DataFrame, vocabulary_path: str, pattern: str = public_tokenizers.PATTERN,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens. The vocabulary is read once, on the driver, and broadcast.

    Null and empty texts have no bytes and no tokens. Special strings of the file count as one
    token each, as the file's library does by default. Rows with null or repeated identifiers
    are counted as they are; further columns are not read, so their names can't clash.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value, pattern)
        for batch in sliced(batches, "text"):
            data = as_binary(batch.column("text"))
            sizes = np.diff(np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1])
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counter(texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens, and whether it exceeds 512 tokens."""
    counted = count_tokens(read_parquet(spark, f"{sf_dir}/documents.parquet"),
                           public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
