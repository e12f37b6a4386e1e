"""Benchmark passages in documents by the q-gram lemma and banded alignment.

Texts become canonical bytes: A-Z lower-cased, ASCII punctuation and white space as single spaces.
Benchmark items are cut into overlapping probes. A text region within k edits of a probe of m bytes
shares at least m + 1 - q (k + 1) of its q-grams, all within k + 1 neighbouring diagonals (text
position minus probe position). So shared q-grams are counted in diagonal bands that overlap such
that every k + 1 diagonals lie inside one band; bands under the bound fall away, the others are
verified by an alignment limited to the band. No probe within its edits is lost, and none is reported
unverified.

A document that quotes less than a probe is found by its verbatim runs: an item's q-grams at every
SEED-th place are seeds, one of which lies in every run of RUN_WORDS words, and each shared seed is extended
on both sides. Items too short for probes are found as whole words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import sliced, small_batches, text_buffer
from hirelens.sources.tables import read_parquet

Q = 8
FILTER_BITS = 22
# A verbatim run of so many whole words or canonical bytes counts as part of an item; words have a letter at least.
RUN_WORDS, RUN_BYTES = 13, 60
SEED = 2 * RUN_WORDS - 1 - Q + 1
# Hits of shared q-grams handled together; a batch with more is counted in pieces, which changes no result.
HITS_AT_ONCE = 500_000
# Text bytes searched together: the arrays of a search are some hundred times as large.
TEXT_AT_ONCE = 1 << 19
SPACE = 32
CANON = np.arange(256, dtype=np.uint8)
CANON[65:91] += 32
CANON[[b for b in range(128) if not chr(b).isalnum()]] = SPACE
# Without a probe (null) and edits: a verbatim run of an item of which no probe is found, or a short item.
FOUND = "doc_id long, item_id long, probe int, probes int, edits int, start long, stop long"


def canonical(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical bytes of all texts, their places in the original, and where each text begins."""
    mapped = CANON[content]
    first = np.zeros(len(mapped) + 1, dtype=bool)
    first[offsets] = True
    blank = mapped == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep |= first[:-1]
    at = np.flatnonzero(keep)
    return mapped[at], at, np.searchsorted(at, offsets)


def qgrams(letters: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each byte, packed into 64 bits."""
    code = letters.astype(np.uint64)
    if len(code) < Q:
        return code[:0]
    for width in (1, 2, 4):
        code = (code[:-width] << np.uint64(8 * width)) | code[width:]
    return code


def _buckets(codes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Index:
    """Probes of a block of benchmark items and the places of all their q-grams."""

    items: np.ndarray      # item of each probe
    numbers: np.ndarray    # number of the probe in its item
    counts: np.ndarray     # probes of the item
    letters: np.ndarray    # probes padded to one width
    sizes: np.ndarray
    budgets: np.ndarray    # edits allowed
    needed: np.ndarray     # q-grams shared at least
    codes: np.ndarray      # sorted
    probes: np.ndarray
    places: np.ndarray
    wanted: np.ndarray
    seeds: np.ndarray      # of codes: whether a verbatim run is looked for from here
    content: np.ndarray    # canonical bytes of all items with probes
    spans: np.ndarray      # of probes: where the item begins and ends in content, and the probe begins
    begins: np.ndarray     # where words begin in content
    ends: np.ndarray
    short: list[tuple[int, bytes]]  # items without probes

    @classmethod
    def build(cls, items: list[tuple[int, str | None]], probe_bytes: int, error: float, least_bytes: int) -> "Index":
        found, spans, held, size, short = [], [], [], 0, []
        for item, text in items:
            content = np.frombuffer((text or "").encode(), dtype=np.uint8)
            letters = canonical(content, np.array([0, len(content)]))[0]
            if len(letters) < max(least_bytes, Q):
                short.append((item, letters.tobytes().strip()))
                continue
            starts = list(range(0, max(len(letters) - probe_bytes, 0) + 1, probe_bytes // 2))
            if starts[-1] + probe_bytes < len(letters):
                starts.append(len(letters) - probe_bytes)
            found += [(item, k, len(starts), letters[s:s + probe_bytes]) for k, s in enumerate(starts)]
            spans += [(size, size + len(letters), size + s) for s in starts]
            # A space between items, so that no word goes on in the next one.
            held += [letters, np.array([SPACE], np.uint8)]
            size += len(letters) + 1
        sizes = np.array([len(f[3]) for f in found], dtype=np.int64)
        letters = np.zeros((len(found), probe_bytes), dtype=np.uint8)
        for k, f in enumerate(found):
            letters[k, :sizes[k]] = f[3]
        budgets = np.minimum((sizes * error).astype(np.int64), sizes // Q - 1)
        grams = [qgrams(f[3]) for f in found]
        codes = np.concatenate([np.zeros(0, np.uint64), *grams])
        probes = np.repeat(np.arange(len(found)), [len(g) for g in grams])
        places = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        spans = np.array(spans, dtype=np.int64).reshape(-1, 3)
        at = spans[probes, 2] + places
        seeds = (at - spans[probes, 0]) % SEED == 0
        seeds[seeds] = np.arange(seeds.sum()) == np.unique(at[seeds], return_index=True)[1][
            np.unique(at[seeds], return_inverse=True)[1]]
        content = np.concatenate([np.zeros(0, np.uint8), *held])
        letter = np.r_[False, content != SPACE, False]
        order = np.argsort(codes, kind="stable")
        wanted = np.zeros(1 << FILTER_BITS, dtype=bool)
        wanted[_buckets(codes)] = True
        column = lambda k: np.array([f[k] for f in found], dtype=np.int64)
        return cls(column(0), column(1), column(2), letters, sizes, budgets, sizes + 1 - Q * (budgets + 1),
                   codes[order], probes[order], places[order], wanted, seeds[order], content, spans,
                   np.flatnonzero(~letter[:-1] & letter[1:]), np.flatnonzero(letter[:-1] & ~letter[1:]),
                   sorted({(item, text) for item, text in short if text}))


@dataclass
class Shared:
    """The q-grams of a batch that the index has: text place, row, first entry of the index, and how many entries.

    A q-gram of very many items has as many hits at every place, so hits are made a piece at a time.
    """

    place: np.ndarray
    row: np.ndarray
    low: np.ndarray
    many: np.ndarray

    def pieces(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, text place, entry) of every hit, about ``at_once`` of them together."""
        ends = np.cumsum(self.many)
        first = 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + at_once, side="right")))
            many, part = self.many[first:last], slice(first, last)
            entry = np.repeat(self.low[part] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            yield np.repeat(self.row[part], many), np.repeat(self.place[part], many), entry
            first = last


def shared_qgrams(index: Index, letters: np.ndarray, offsets: np.ndarray) -> Shared:
    codes = qgrams(letters)
    at = np.flatnonzero(index.wanted[_buckets(codes)])
    rows = np.searchsorted(offsets, at, side="right") - 1
    inside = at + Q <= offsets[rows + 1]
    at, rows = at[inside], rows[inside]
    low, high = np.searchsorted(index.codes, codes[at]), np.searchsorted(index.codes, codes[at], side="right")
    held = high > low
    return Shared(at[held], rows[held], low[held], (high - low)[held])


def _band_keys(index: Index, offsets: np.ndarray, rows: np.ndarray, place: np.ndarray,
               entry: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every hit its two bands, as (row, probe, band) in one number, the hits these need, and their hashed bins."""
    probe, offset = index.probes[entry], index.places[entry]
    # Diagonals are counted from the text's own start, shifted so that none is negative.
    diagonal = place - offsets[rows] - offset + index.letters.shape[1]
    stride = index.budgets[probe] + 1
    band = diagonal // stride + 1
    key = ((rows * len(index.sizes) + probe) << 32) + band
    key, needed = np.r_[key, key - 1], np.r_[index.needed[probe], index.needed[probe]]
    return key, needed, _buckets(key.view(np.uint64), bits)


def candidates(index: Index, offsets: np.ndarray, shared: Shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, probe, first diagonal) of the bands with enough shared q-grams."""
    if not len(shared.place):
        return (np.zeros(0, np.int64),) * 3
    # Counting in hashed bins first spares the sort of nearly all hits: a bin counts at least as many as its bands.
    totals, kept, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    hits_in_all = int(shared.many.sum())
    # Few hits need few bins.
    bits = min(FILTER_BITS, max(12, hits_in_all.bit_length() + 2))
    several = hits_in_all > HITS_AT_ONCE
    if several:
        totals = np.zeros(1 << bits, dtype=np.int64)
        for hits in shared.pieces(HITS_AT_ONCE):
            totals += np.bincount(_band_keys(index, offsets, *hits, bits)[2], minlength=1 << bits)
    for hits in shared.pieces(HITS_AT_ONCE):
        key, needed, bins = _band_keys(index, offsets, *hits, bits)
        found = totals if several else np.bincount(bins, minlength=1 << bits)
        key, more = np.unique(key[found[bins] >= needed], return_counts=True)
        if len(kept):
            key, place = np.unique(np.r_[kept, key], return_inverse=True)
            more = np.bincount(place, np.r_[counts, more]).astype(np.int64)
        kept, counts = key, more
    key = kept
    row, probe = np.divmod(key >> 32, len(index.sizes))
    enough = counts >= index.needed[probe]
    row, probe, band = row[enough], probe[enough], (key & 0xFFFFFFFF)[enough] - 1
    return row, probe, band * (index.budgets[probe] + 1) - index.letters.shape[1]


def align(index: Index, letters: np.ndarray, offsets: np.ndarray, rows: np.ndarray, probe: np.ndarray,
          first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits between each probe and any text region inside its band, and that region (canonical places)."""
    width = int(2 * (index.budgets[probe].max() + 1))
    base, size = offsets[rows], offsets[rows + 1] - offsets[rows]
    sizes = index.sizes[probe]
    cost = np.zeros((len(rows), width + 1), dtype=np.int32)
    cost[:, width] = 1 << 20  # beyond the band
    begin = first[:, None] + np.arange(width + 1)[None, :]
    last_cost, last_begin = cost.copy(), begin.copy()
    diagonals = np.arange(width)[None, :]
    for i in range(int(sizes.max())):
        place = first[:, None] + i + diagonals
        there = (place >= 0) & (place < size[:, None])
        text = np.where(there, letters[np.minimum(base[:, None] + np.maximum(place, 0), len(letters) - 1)], 0)
        best = cost[:, :width] + (text != index.letters[probe, i][:, None])
        origin = begin[:, :width].copy()
        skipped = cost[:, 1:] + 1
        better = skipped < best
        best, origin = np.where(better, skipped, best), np.where(better, begin[:, 1:], origin)
        for t in range(1, width):
            taken = best[:, t - 1] + 1
            better = taken < best[:, t]
            best[:, t] = np.where(better, taken, best[:, t])
            origin[:, t] = np.where(better, origin[:, t - 1], origin[:, t])
        cost[:, :width], begin[:, :width] = best, origin
        done = sizes == i + 1
        last_cost[done], last_begin[done] = cost[done], begin[done]
    at = last_cost[:, :width].argmin(axis=1)
    pick = np.arange(len(rows))
    start = np.clip(last_begin[pick, at], 0, size)
    stop = np.clip(first + sizes + at, start, size)
    return last_cost[pick, at], base + start, base + stop


def runs(index: Index, letters: np.ndarray, offsets: np.ndarray, shared: Shared) -> tuple[np.ndarray, ...]:
    """(row, probe, start, stop) of verbatim runs of enough words or bytes; the probe names the item."""
    parts = [_runs(index, letters, offsets, *hits) for hits in shared.pieces(HITS_AT_ONCE)]
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4


def _runs(index: Index, letters: np.ndarray, offsets: np.ndarray, rows: np.ndarray, place: np.ndarray,
          entry: np.ndarray) -> tuple[np.ndarray, ...]:
    seed = index.seeds[entry]
    rows, place, entry = rows[seed], place[seed], entry[seed]
    probe = index.probes[entry]
    at = index.spans[probe, 2] + index.places[entry]
    # Seeds stand closer than RUN_BYTES, so a longer run is pieced together by the next ones.
    low = -np.minimum(np.minimum(place - offsets[rows], at - index.spans[probe, 0]), RUN_BYTES)
    high = np.minimum(np.minimum(offsets[rows + 1] - place, index.spans[probe, 1] - at), Q + RUN_BYTES)
    start, stop = np.zeros(len(at), np.int64), np.full(len(at), Q)
    for edge, step, bound in ((stop, 1, high), (start, -1, low)):
        going = np.flatnonzero(edge != bound)
        while len(going):
            ahead = edge[going] if step > 0 else edge[going] - 1
            going = going[letters[place[going] + ahead] == index.content[at[going] + ahead]]
            edge[going] += step
            going = going[edge[going] != bound[going]]
    words = np.searchsorted(index.ends, at + stop, side="right") - np.searchsorted(index.begins, at + start)
    keep = (words >= RUN_WORDS) | (stop - start >= RUN_BYTES)
    return rows[keep], probe[keep], (place + start)[keep], (place + stop)[keep]


def short_items(index: Index, letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, number in index.short, start, stop) of every short item that occurs as whole words."""
    none = (np.zeros(0, np.int64),) * 4
    if not index.short or not len(letters):
        return none
    edge = letters == SPACE
    first = np.zeros(len(letters) + 1, dtype=bool)
    first[offsets] = True
    begins = np.flatnonzero(~edge & (first[:-1] | np.r_[True, edge[:-1]]))
    rows = np.searchsorted(offsets, begins, side="right") - 1
    codes = qgrams(np.r_[letters, np.zeros(Q - 1, np.uint8)])[begins]
    parts = [none]
    for size in sorted({len(text) for _, text in index.short}):
        numbers = np.array([k for k, (_, text) in enumerate(index.short) if len(text) == size])
        wide = np.array([list(index.short[k][1].ljust(Q, b"\0")) for k in numbers], dtype=np.uint8)
        spare = np.uint64(8 * (Q - min(size, Q)))
        keys = qgrams(wide[:, :Q].reshape(-1))[::Q] >> spare
        order = np.argsort(keys, kind="stable")
        whole = begins + size <= offsets[rows + 1]
        whole &= first[np.minimum(begins + size, len(letters))] | edge[np.minimum(begins + size, len(letters) - 1)]
        at, row, code = begins[whole], rows[whole], codes[whole] >> spare
        low, high = np.searchsorted(keys[order], code), np.searchsorted(keys[order], code, side="right")
        many = high - low
        pick = order[np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())] if len(at) else numbers[:0]
        at, row = np.repeat(at, many), np.repeat(row, many)
        same = (letters[at[:, None] + np.arange(size)] == wide[pick, :size]).all(axis=1)
        parts.append((row[same], numbers[pick[same]], at[same], at[same] + size))
    return tuple(np.concatenate(p) for p in zip(*parts))


def matches(index: Index, texts: pa.Array, at_once: int = 4096) -> tuple[np.ndarray, ...]:
    """(row, probe, edits, start, stop) of every probe found; places are bytes of the original text."""
    return search(index, texts, at_once)[0]


def search(index: Index, texts: pa.Array, at_once: int = 4096) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The probes found (see ``matches``), and (row, item, probes, start, stop) of items found without any of their probes."""
    content, offsets = text_buffer(texts)
    letters, origin, inner = canonical(content, offsets)
    shared = shared_qgrams(index, letters, inner)
    origin_end = np.r_[origin, len(content)]
    probed = _probes(index, letters, inner, shared, at_once)
    run_rows, run_probe, run_start, run_stop = runs(index, letters, inner, shared)
    short_rows, number, short_start, short_stop = short_items(index, letters, inner)
    rows = np.concatenate([run_rows, short_rows])
    items = np.concatenate([index.items[run_probe], np.array([i for i, _ in index.short], dtype=np.int64)[number]])
    counts = np.concatenate([index.counts[run_probe], np.zeros(len(number), np.int64)])
    start, stop = np.concatenate([run_start, short_start]), np.concatenate([run_stop, short_stop])

    def original(rows: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return origin_end[start] - offsets[rows], origin_end[np.maximum(stop - 1, start)] + 1 - offsets[rows]

    # One row a document and item: the first place to the last.
    order = np.lexsort((start, items, rows))
    rows, items, counts, start, stop = (x[order] for x in (rows, items, counts, start, stop))
    if len(rows):
        begin = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (items[1:] != items[:-1])])
        rows, items, counts, start, stop = rows[begin], items[begin], np.maximum.reduceat(counts, begin), start[begin], np.maximum.reduceat(stop, begin)
        seen = set(zip(probed[0].tolist(), index.items[probed[1]].tolist()))
        new = np.array([pair not in seen for pair in zip(rows.tolist(), items.tolist())])
        rows, items, counts, start, stop = (x[new] for x in (rows, items, counts, start, stop))
    found = (*probed[:3], *original(probed[0], *probed[3:]))
    return found, (rows, items, counts, *original(rows, start, stop))


def _probes(index: Index, letters: np.ndarray, inner: np.ndarray, shared: Shared, at_once: int) -> tuple[np.ndarray, ...]:
    """(row, probe, edits, start, stop) of every probe found; places are canonical bytes of the batch."""
    rows, probe, first = candidates(index, inner, shared)
    parts = []
    for k in range(0, len(rows), at_once):
        part = slice(k, k + at_once)
        edits, start, stop = align(index, letters, inner, rows[part], probe[part], first[part])
        good = edits <= index.budgets[probe[part]]
        parts.append(np.stack([rows[part], probe[part], edits, start, stop])[:, good])
    if not parts:
        return tuple(np.zeros((5, 0), np.int64))
    rows, probe, edits, start, stop = np.concatenate(parts, axis=1)
    # The best of several bands and places a row and probe.
    order = np.lexsort((start, edits, probe, rows))
    rows, probe, edits, start, stop = (x[order] for x in (rows, probe, edits, start, stop))
    keep = np.r_[True, (rows[1:] != rows[:-1]) | (probe[1:] != probe[:-1])][:len(rows)]
    rows, probe, edits, start, stop = (x[keep] for x in (rows, probe, edits, start, stop))
    return rows, probe, edits, start, stop


def indexes(benchmark: DataFrame, item_col: str, text_col: str, probe_bytes: int, error: float, least_bytes: int,
            block_bytes: int) -> Iterator[Index]:
    """The benchmark in blocks of about ``block_bytes``, each small enough to be broadcast."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & F.col("item").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).distinct().orderBy("item", "text")
        yield Index.build([tuple(r) for r in part.collect()], probe_bytes, error, least_bytes)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", probe_bytes: int = 100, error: float = 0.1, least_bytes: int = 30,
         block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document row and probe found, or item found without a probe: FOUND. Probes overlap by half.

    Null and empty texts match nothing. Items under ``least_bytes`` canonical bytes have no probe and must
    occur as whole words; of others a verbatim run of RUN_WORDS words or RUN_BYTES bytes suffices.
    Rows with repeated or null identifiers are searched like any other. Without items there is no row.
    Other columns are not read. A benchmark larger than ``block_bytes`` takes one pass a block.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for index in indexes(benchmark, item_col, item_text, probe_bytes, error, least_bytes, block_bytes):
        part = narrow.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast(index)), FOUND)
        result = part if result is None else result.unionByName(part)
    return result


def _finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", TEXT_AT_ONCE):
            index = shared.value
            (rows, probe, edits, start, stop), (others, items, counts, begin, end) = search(index, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(np.r_[rows, others])), pa.array(np.r_[index.items[probe], items]),
                 pa.concat_arrays([pa.array(index.numbers[probe].astype(np.int32)), pa.nulls(len(others), pa.int32())]),
                 pa.array(np.r_[index.counts[probe], counts].astype(np.int32)),
                 pa.array(np.r_[edits, np.zeros(len(others), np.int64)].astype(np.int32)),
                 pa.array(np.r_[start, begin]), pa.array(np.r_[stop, end])],
                names=["doc_id", "item_id", "probe", "probes", "edits", "start", "stop"])
    return run


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", probe_bytes: int = 100, error: float = 0.1, least_bytes: int = 30,
               block_bytes: int = 4 << 20) -> DataFrame:
    """The rows in which no item is found, in whole or in part, with all their columns and without a shuffle."""
    small_batches(docs.sparkSession)
    for index in indexes(benchmark, item_col, item_text, probe_bytes, error, least_bytes, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(_cleaner(shared, text_col), docs.schema)
    return docs


def _cleaner(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, TEXT_AT_ONCE):
            keep = np.ones(batch.num_rows, dtype=bool)
            probed, others = search(shared.value, batch.column(text_col))
            keep[probed[0]] = False
            keep[others[0]] = False
            yield batch.filter(pa.array(keep))
    return run


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds, in whole or in part."""
    found = find(read_parquet(spark, f"{sf_dir}/documents.parquet"), read_parquet(spark, f"{sf_dir}/benchmark.parquet"))
    return found.groupBy("doc_id", "item_id").agg(
        F.countDistinct("probe").alias("probes_found"), F.max("probes").alias("probes"),
        F.sum("edits").alias("edits"), F.min("start").alias("start"), F.max("stop").alias("stop"))
