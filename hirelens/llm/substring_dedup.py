"""Repeated word sequences removed by suffix automata of reference shards.

A window is a run of 20 words; its anchor is the smallest hash among its six-word runs. Neighbouring
windows with the same anchor form a segment, so that equal windows, wherever they stand, lie in
segments with the same anchor. Anchors therefore cut the corpus into reference shards that can be
searched apart from each other, and shards stay small however large the corpus is:

1. Anchors that occur once have no repeated window. The others are marked in a bitmap of fixed size.
2. Segments under marked anchors are grouped by content: all but the first of equal segments are
   repeated as a whole, and only the first of them goes on.
3. Different segments under one anchor go to the anchor's shard. There the automaton of all earlier
   segments meets each segment as a stream of words: its matching statistics say how long a sequence
   ending at each word has been seen before, and sequences of 20 words or more are repeated. Anchors
   with very many different segments send single windows instead, sharded by the window's content.

What a bitmap marks wrongly costs time but changes no result: the automata compare the words' 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import bitmap, marked, ragged, sliced, small_batches, stored
from hirelens.llm.words import MULTIPLIER, mix, run_hashes, split_words, word_hashes
from hirelens.sources.tables import read_parquet

ANCHOR = 6
ANCHOR_BITS, WIDE_BITS = 27, 24
# Words of one shard, and different segments under one anchor beyond which its windows are sharded one by one.
SHARD_WORDS, WIDE = 100_000, 1000
SEGMENT = "anchor long, content long, doc_id long, variant long, start int, windows int, loops boolean"
PIECE = "shard long, doc_id long, variant long, start int, words array<long>"
SPAN = "doc_id long, variant long, start int, stop int"


def segments(words: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, row, first word, windows, loops) of every segment; words count from the batch's first word.

    A segment loops if its anchor stands in it more than once; only then can it hold a window twice.
    """
    grams = run_hashes(words, ANCHOR)
    span = window - ANCHOR + 1
    if len(grams) < span:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, bool)
    low, width = grams, 1
    while 2 * width <= span:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    # low[i] is the anchor of the window that begins at word i, if that window ends inside its row.
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(low)]
    good = np.arange(len(low)) + window <= offsets[row + 1]
    begins = good & np.r_[True, (low[1:] != low[:-1]) | (row[1:] != row[:-1])]
    at = np.flatnonzero(begins)
    ends = np.flatnonzero(good & np.r_[begins[1:] | ~good[1:], True])
    many = ends - at + 1
    sizes = many + span - 1
    first = np.cumsum(sizes) - sizes
    inside = np.repeat(at - first, sizes) + np.arange(sizes.sum())
    equal = grams[inside] == np.repeat(low[at], sizes)
    loops = np.add.reduceat(equal.astype(np.int64), first) > 1 if len(first) else np.zeros(0, bool)
    return low[at], row[at], at, many, loops


def content_hashes(words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each sequence of words, from sums over prefixes."""
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(words), MULTIPLIER)], dtype=np.uint64)
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(words), inverse)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(words * powers[:-1], dtype=np.uint64)]
    return mix((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64))


def place_bits(doc_id: np.ndarray, variant: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Bitmap position of a segment's place."""
    code = mix(doc_id.astype(np.int64).view(np.uint64) * MULTIPLIER + variant.view(np.uint64))
    return (mix(code + start.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64)


def high_bits(column: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(column), 64 - bits)


def anchors(narrow: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, offsets = word_hashes(split_words(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(segments(words, offsets, window)[0].view(np.int64))], names=["anchor"])

    return narrow.select("text").mapInArrow(run, "anchor long")


def _placed(batch: pa.RecordBatch, row: np.ndarray, at: np.ndarray, offsets: np.ndarray):
    doc_id = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
    variant = batch.column("variant").to_numpy(zero_copy_only=False)[row]
    return doc_id, variant, at - offsets[row]


def repeated_segments(narrow: DataFrame, window: int, repeated: np.ndarray) -> DataFrame:
    """SEGMENT rows under marked anchors, and those that may repeat inside themselves."""
    shared = narrow.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, offsets = word_hashes(split_words(batch.column("text")))
            anchor, row, at, many, loops = segments(words, offsets, window)
            keep = marked(shared.value, (anchor >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64)) | loops
            anchor, row, at, many, loops = anchor[keep], row[keep], at[keep], many[keep], loops[keep]
            content = content_hashes(words, at, at + many + window - 1)
            doc_id, variant, start = _placed(batch, row, at, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc_id), pa.array(variant),
                 pa.array(start.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(loops)],
                names=["anchor", "content", "doc_id", "variant", "start", "windows", "loops"])

    return narrow.mapInArrow(run, SEGMENT)


def pieces(narrow: DataFrame, window: int, firsts: np.ndarray, wide: np.ndarray, shards: int) -> DataFrame:
    """PIECE rows: the words of the marked segments, by shard."""
    context = narrow.sparkSession.sparkContext
    shared = context.broadcast((firsts, wide))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, wide = shared.value
        for batch in sliced(batches, "text"):
            words, offsets = word_hashes(split_words(batch.column("text")))
            anchor, row, at, many, _ = segments(words, offsets, window)
            doc_id, variant, start = _placed(batch, row, at, offsets)
            keep = marked(firsts, place_bits(doc_id, variant, start))
            anchor, row, at, many = anchor[keep], row[keep], at[keep], many[keep]
            broad = marked(wide, (anchor >> np.uint64(64 - WIDE_BITS)).astype(np.int64))
            single = np.repeat(at[broad], many[broad])
            single = single + np.arange(len(single)) - np.repeat(np.cumsum(many[broad]) - many[broad], many[broad])
            begin = np.r_[at[~broad], single]
            end = np.r_[(at + many + window - 1)[~broad], single + window]
            rows = np.r_[row[~broad], np.repeat(row[broad], many[broad])]
            key = np.r_[mix(anchor[~broad]), content_hashes(words, single, single + window)]
            doc_id, variant, start = _placed(batch, rows, begin, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array((key % np.uint64(shards)).astype(np.int64)), pa.array(doc_id), pa.array(variant),
                 pa.array(start.astype(np.int32)),
                 ragged([words[b:e].view(np.int64) for b, e in zip(begin.tolist(), end.tolist())], pa.int64())],
                names=["shard", "doc_id", "variant", "start", "words"])

    return narrow.mapInArrow(run, PIECE)


class Automaton:
    """Suffix automaton of word sequences. ``stream`` appends a sequence and tells its matching statistics."""

    def __init__(self):
        self.following: list[dict[int, int]] = [{}]
        self.suffix, self.length = [-1], [0]

    def stream(self, words: list[int]) -> list[int]:
        """For each word the longest sequence ending there that stood earlier, in a sequence before or in this one."""
        following, suffix, length = self.following, self.suffix, self.length
        last, found = 0, []
        for word in words:
            state = last
            target = following[last].get(word)
            if target is None:
                last = len(length)
                following.append({})
                length.append(length[state] + 1)
                suffix.append(0)
                while state >= 0 and word not in following[state]:
                    following[state][word] = last
                    state = suffix[state]
                if state >= 0:
                    suffix[last] = self._solid(state, word)
                found.append(length[suffix[last]])
            else:
                last = self._solid(state, word)
                found.append(length[last])
        return found

    def _solid(self, state: int, word: int) -> int:
        """The state reached by the word whose longest sequence is one longer, split off if need be."""
        following, suffix, length = self.following, self.suffix, self.length
        target = following[state][word]
        if length[target] == length[state] + 1:
            return target
        copy = len(length)
        following.append(dict(following[target]))
        length.append(length[state] + 1)
        suffix.append(suffix[target])
        suffix[target] = copy
        while state >= 0 and following[state].get(word) == target:
            following[state][word] = copy
            state = suffix[state]
        return copy


def repeated_spans(window: int):
    """Of one shard: spans of words that earlier pieces, or earlier words of the same piece, hold."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("variant", "ascending"), ("start", "ascending")])
        automaton, rows, before = Automaton(), [], None
        for doc_id, variant, start, words in zip(*(table.column(c).to_pylist() for c in ("doc_id", "variant", "start", "words"))):
            if (doc_id, variant, start) == before:
                continue  # the same place of a repeated row
            before = (doc_id, variant, start)
            begin = end = None
            for k, matched in enumerate(automaton.stream(words)):
                if matched >= window:
                    if end is None or k - window + 1 > end:
                        if end is not None:
                            rows.append((doc_id, variant, start + begin, start + end))
                        begin = k - window + 1
                    end = k + 1
            if end is not None:
                rows.append((doc_id, variant, start + begin, start + end))
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                        names=["doc_id", "variant", "start", "stop"])
    return run


def spans(narrow: DataFrame, window: int) -> DataFrame:
    """SPAN rows: words of each document that a repeated window covers. Rows may overlap."""
    known = narrow.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    twice = anchors(known, window).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = bitmap(twice.select(high_bits("anchor", ANCHOR_BITS).alias("at")), ANCHOR_BITS)
    held = stored(repeated_segments(known, window, repeated), "substring-segments")
    place = F.struct("doc_id", "variant", "start")
    classes = stored(held.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.max("windows").alias("windows"),
                                                               F.max("loops").alias("loops")), "substring-classes")
    copies = held.join(classes.select("anchor", "content", "first"), ["anchor", "content"]).where(place != F.col("first"))
    whole = copies.select("doc_id", "variant", "start", (F.col("start") + F.col("windows") + window - 1).alias("stop"))
    # Only segments with different neighbours under their anchor, or that loop, need the automata.
    many = stored(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "substring-anchors")
    open_ = stored(classes.join(many, "anchor", "left").where(
        F.col("classes").isNotNull() | F.col("loops")).select("first", "windows", "classes"), "substring-open")
    # Under crowded anchors each window travels by itself.
    sent = F.when(F.col("classes") > WIDE, F.col("windows") * window).otherwise(F.col("windows") + window - 1)
    words = open_.agg(F.sum(sent)).first()[0] or 0
    wide = bitmap(many.where(F.col("classes") > WIDE).select(high_bits("anchor", WIDE_BITS).alias("at")), WIDE_BITS)
    firsts = bitmap(_places(open_), ANCHOR_BITS)
    cut = pieces(known, window, firsts, wide, max(1, -(-words // SHARD_WORDS)))
    found = cut.groupBy("shard").applyInArrow(repeated_spans(window), SPAN)
    return stored(whole.unionByName(found), "substring-spans")


def _places(open_: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, variant, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(place_bits(doc_id, variant, start))], names=["at"])

    return open_.select("first.doc_id", "first.variant", "first.start").mapInArrow(run, "at long")


def cut_text(words: list[bytes], starts: list[int], stops: list[int]) -> list[bytes]:
    """The words outside all spans."""
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(gone, starts, 1)
    np.add.at(gone, stops, -1)
    return [w for w, depth in zip(words, np.cumsum(gone[:-1])) if not depth]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the remaining words joined by single spaces).

    Null and empty texts have no words. Earlier is a smaller identifier, or the same document and an
    earlier start. Rows with a null identifier have no order: they are kept whole and remove nothing.
    Rows that repeat identifier and text are the same document; rows that repeat an identifier with
    other texts are ordered by a hash of the text. Other columns are not read.
    """
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("variant"),
                         F.col(text_col).alias("text"))
    gone = spans(narrow, window).groupBy("doc_id", "variant").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")).select("doc_id", "variant", "spans.start", "spans.stop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows = split_words(batch.column("text"))
            kept = [words if start is None else cut_text(words, start, stop) for words, start, stop in zip(
                rows, batch.column("start").to_pylist(), batch.column("stop").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([len(r) - len(k) for r, k in zip(rows, kept)], pa.int64()),
                 pa.array([b" ".join(k).decode() for k in kept], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return narrow.join(gone, ["doc_id", "variant"], "left").select("doc_id", "text", "start", "stop").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, how many are removed, and a digest of what is kept."""
    found = dedup_substrings(read_parquet(spark, f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SUBSTRING_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS held
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY held ORDER BY doc_id, i) > 1 AS again FROM w
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS places FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM r WHERE again) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM d)
  ANTI JOIN (SELECT doc_id, unnest(places) AS j FROM gone) USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
