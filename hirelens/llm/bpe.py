"""Byte-level BPE as Spark higher-order functions.

Tasks cut texts into pre-tokens and number the distinct ones, so that a word is merged once a task
(once per million distinct words, so that memory stays bounded). The merging is a fold over the
word's array of byte symbols: each step takes the pair of lowest rank (leftmost first), puts the
merged symbol in its place and looks up the two pairs that this symbol is part of. Ranks come from a
literal map in the plan: long arrays addressed by hash and displacement, whose entries tell the pair
and the merged symbol. The words' ids are then laid out text by text, further on in the same task.
Decoding looks up the binary piece of every id and concatenates the pieces.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import gathered, small_batches
from hirelens.sources.tables import read_parquet

# Text bytes whose new words are merged together, and distinct words after which a task starts counting anew.
BATCH_BYTES = 4 << 20
MOST_WORDS = 1 << 20
ID_BITS, PLACE_BITS = 20, 22
NO_PAIR = 1 << ID_BITS
# Stands before and after a word; it is no rank, so it merges with nothing.
EDGE = NO_PAIR - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a file with a base64 piece and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}


class RankMap:
    """The rank file as two long arrays that find a pair in two look-ups (hash and displace).

    A pair (left, right) is one number, ``left * factor + right``, and belongs to a bucket; ``shifts[bucket]``
    plus the pair's own place is its entry. An entry holds ``number << ID_BITS | merged`` if the two pieces
    together are a piece, else something else. Buckets are placed first-fit, the fullest first.
    """

    BUCKET_BITS, BUCKETS, PLACES = 15, 1 << 15, 1 << 18

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= EDGE:
            raise ValueError(f"ranks must stay below {EDGE}")
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no piece for the bytes {missing}")
        found = []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    found.append((left, right, rank))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # What two neighbouring bytes merge into.
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), NO_PAIR) for b in range(256)] for a in range(256)], dtype=np.int64)
        left, right, merged = np.array(found, dtype=np.int64).reshape(-1, 3).T
        draw = np.random.default_rng(0)
        while True:
            self.factor = int(draw.integers(1 << ID_BITS, 1 << ID_BITS + 2)) | 1
            number = self.number(left, right)
            bucket, place = self.home(number)
            if len(np.unique(bucket * self.PLACES + place)) == len(left):
                break
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
        self.shifts = np.zeros(self.BUCKETS, dtype=np.int64)
        self.entries = np.zeros(2 * self.PLACES, dtype=np.int64)
        for group in sorted(groups, key=len, reverse=True):
            while True:
                tried = draw.integers(self.PLACES, size=64)
                free = (self.entries[tried[:, None] + place[group][None, :]] == 0).all(axis=1)
                if free.any():
                    break
            shift = tried[free.argmax()]
            self.shifts[bucket[group[0]]] = shift
            self.entries[shift + place[group]] = (number[group] << ID_BITS) | merged[group]

    def number(self, left, right):
        return left * self.factor + right

    def home(self, number) -> tuple:
        """Bucket and place of a pair's number; the same arithmetic for numpy arrays and Spark columns."""
        if isinstance(number, Column):
            return number.bitwiseAND(self.BUCKETS - 1), F.shiftright(number, self.BUCKET_BITS).bitwiseAND(self.PLACES - 1)
        return number & (self.BUCKETS - 1), (number >> self.BUCKET_BITS) & (self.PLACES - 1)


def long_literal(values: np.ndarray) -> Column:
    """A literal array of longs; one text, which the optimiser folds into the array."""
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast("array<bigint>")


def merged_id(ranks: RankMap, shifts: Column, entries: Column):
    """Of two symbols: the merged symbol, or a number of at least NO_PAIR if they don't merge."""
    def look_up(left: Column, right: Column) -> Column:
        number = ranks.number(left, right)
        bucket, place = ranks.home(number)
        return entries[shifts[bucket] + place].bitwiseXOR(F.shiftleft(number, ID_BITS))

    return look_up


# A symbol of a word under way is one long: from the top, what it merges into with the next symbol (NO_PAIR: nothing),
# the place of its first byte in the word, and its id. The smallest long is the lowest rank, of those the leftmost.
ID_MASK, REST_MASK = NO_PAIR - 1, (1 << ID_BITS + PLACE_BITS) - 1
PLACE_MASK = REST_MASK - ID_MASK


def byte_symbols(words: list[bytes], ranks: RankMap) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the words' bytes, an EDGE before and after each word, and where each word's symbols begin."""
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    ends = np.cumsum(np.r_[0, sizes])
    inner = np.ones(ends[-1], dtype=bool)
    inner[ends[:-1]] = inner[ends[1:] - 1] = False
    content = np.zeros(ends[-1], dtype=np.uint8)
    content[inner] = np.frombuffer(b"".join(words), np.uint8)
    merged = np.full(ends[-1], NO_PAIR, dtype=np.int64)
    both = np.flatnonzero(inner[:-1] & inner[1:])
    merged[both] = ranks.byte_pairs[content[both], content[both + 1]]
    places = (np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)) & (PLACE_MASK >> ID_BITS)
    ids = np.where(inner, ranks.byte_ids[content], EDGE)
    return (merged << ID_BITS + PLACE_BITS) | (places << ID_BITS) | ids, ends


def merge_word(symbols: Column, look_up) -> Column:
    """Fold an array of symbols (``byte_symbols``) into the ids of its pieces.

    A step takes the smallest symbol, puts the merged one in the place of it and its neighbour and looks up the
    two pairs around the new symbol, so a word needs look-ups in proportion to its length. Once no pair merges,
    nothing changes any more. Places repeat in words of more than 4 million bytes; there the leftmost of
    equal pairs is the leftmost by that place.
    """
    def symbol(merged: Column, rest: Column) -> Column:
        return F.shiftleft(F.least(merged, F.lit(NO_PAIR)), ID_BITS + PLACE_BITS).bitwiseOR(rest)

    def step(state: Column, _: Column) -> Column:
        def replaced(low: Column) -> Column:
            at = F.array_position(state, low).cast("int")
            merged, before = F.shiftright(low, ID_BITS + PLACE_BITS), state[at - 2]
            around = F.array(
                symbol(look_up(before.bitwiseAND(ID_MASK), merged), before.bitwiseAND(REST_MASK)),
                symbol(look_up(merged, state[at + 1].bitwiseAND(ID_MASK)), low.bitwiseAND(PLACE_MASK).bitwiseOR(merged)))
            return F.concat(F.slice(state, 1, at - 2), around, F.slice(state, at + 2, F.size(state)))

        return named_once(F.array_min(state), lambda low: F.when(low < (NO_PAIR << ID_BITS + PLACE_BITS), replaced(low)).otherwise(state))

    steps = F.sequence(F.lit(2), F.greatest(F.size(symbols) - 2, F.lit(2)))
    return F.aggregate(steps, symbols, step, lambda s: F.transform(F.slice(s, 2, F.size(s) - 2), lambda x: x.bitwiseAND(ID_MASK).cast("int")))


def word_batches(docs: DataFrame, ranks: RankMap, pattern: str, batch_bytes: int = BATCH_BYTES, most_words: int = MOST_WORDS) -> DataFrame:
    """One row per batch of texts: the keys, how many words each has, all words by number (32-bit, in order), the
    words that are new in the task, as symbols, and whether numbers begin anew with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern)
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        for batch in gathered(batches, "text", batch_bytes):
            if len(number) > most_words:
                number.clear()
            known = len(number)
            sizes, places = [], []
            for text in batch.column("text").to_pylist():
                found = cut.findall(text) if text else ()
                sizes.append(len(found))
                places.append(np.fromiter(map(number.__getitem__, found), "<i4", len(found)))
            symbols, ends = byte_symbols([w.encode() for w in islice(number, known, None)], ranks)
            word_list = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(symbols))
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [whole(batch.column("key")), whole(pa.array(sizes, pa.int32())), pa.array([b"".join(p.tobytes() for p in places)]),
                 whole(word_list), pa.array([known == 0])], names=["keys", "sizes", "places", "words", "anew"])

    key = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(
        run, f"keys array<{key}>, sizes array<int>, places binary, words array<array<bigint>>, anew boolean")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, key: Column | None = None,
           text_col: str = "text", id_col: str = "doc_id", batch_bytes: int = BATCH_BYTES,
           most_words: int = MOST_WORDS) -> DataFrame:
    """Per row: key (its identifier, or ``key``) and ids, an array of the text's token ids.

    Null and empty texts have no ids. Rows with repeated or null identifiers are encoded like any
    other; columns other than those named are not read. A pre-token of many thousand letters takes as
    many steps of the fold, each of them over an array of its length.
    """
    return _encoded(docs, ranks, pattern, key, text_col, id_col, "key {kind}, ids array<int>", lambda keys, ids: {"key": keys, "ids": ids},
                    batch_bytes, most_words)


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: Column | None, text_col: str, id_col: str,
             schema: str, finish: Callable[[pa.Array, pa.ListArray], dict], batch_bytes: int = BATCH_BYTES,
             most_words: int = MOST_WORDS) -> DataFrame:
    """What ``finish`` makes of the keys and ids of a batch of texts, in the task that lays them out."""
    small_batches(docs.sparkSession)
    table = RankMap(ranks)
    named = docs.select((F.col(id_col) if key is None else key).alias("key"), F.col(text_col).alias("text"))
    batches = word_batches(named, table, pattern, batch_bytes, most_words)

    def merged(literals: Column) -> Column:
        look_up = merged_id(table, literals["shifts"], literals["entries"])
        return F.transform("words", lambda w: merge_word(w, look_up))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids in laid_out(batches):
            columns = finish(keys, ids)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    literals = F.struct(long_literal(table.shifts).alias("shifts"), long_literal(table.entries).alias("entries"))
    kind = named.schema["key"].dataType.simpleString()
    return batches.select("keys", "sizes", "places", "anew", named_once(literals, merged).alias("pieces")).mapInArrow(
        run, schema.format(kind=kind))


def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Keys, and the ids of every text: those of its words, one word after the other."""
    ids, lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for batch in batches:
        for row in range(batch.num_rows):
            keys, sizes, words = (batch.column(c).slice(row, 1).flatten() for c in ("keys", "sizes", "pieces"))
            places = np.frombuffer(batch.column("places")[row].as_buffer(), dtype="<i4")
            if batch.column("anew")[row].as_py():
                ids, lengths = ids[:0], lengths[:0]
            ids = np.concatenate([ids, words.flatten().to_numpy()])
            lengths = np.concatenate([lengths, np.diff(words.offsets.to_numpy())])
            starts, counts = np.cumsum(lengths) - lengths, lengths[places]
            ends = np.cumsum(counts)
            flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[places] - (ends - counts), counts)]
            borders = np.r_[0, ends][np.r_[0, np.cumsum(sizes.to_numpy())]]
            yield keys, pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(flat))


def named_once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def piece_list(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: their pieces one after the other. An id without a piece gives null."""
    pieces = piece_list(ranks)
    # One Latin-1 letter per byte, pieces parted by a letter beyond them: a text that the optimiser folds into an array.
    parted = "\u0100".join(p.decode("latin-1") for p in pieces)
    listed = F.split(F.lit(parted), "\u0100")
    known = F.forall(ids, lambda i: (i >= 0) & (i < len(pieces)))
    return F.when(known, F.encode(F.array_join(F.transform(ids, lambda i: F.get(listed, i.cast("int"))), ""), "ISO-8859-1"))


def _id_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Each row's ids."""
    bounds = column.offsets.to_numpy()
    flat = column.flatten().to_numpy()
    for first, last in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0]):
        yield flat[first:last].tolist()


def encode_decoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, key: Column | None = None,
                   text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``encode`` with ``decoded``, the bytes that the ids stand for: their pieces one after the other."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_list(ranks))

    def finish(keys: pa.Array, ids: pa.ListArray) -> dict:
        piece = shared.value.__getitem__
        return {"key": keys, "ids": ids, "decoded": pa.array([b"".join(map(piece, x)) for x in _id_lists(ids)], pa.binary())}

    return _encoded(docs, ranks, pattern, key, text_col, id_col, "key {kind}, ids array<int>, decoded binary", finish)


@cache
def _numerals(count: int) -> list[bytes]:
    return [b"%d" % k for k in range(count)]


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, text_col: str = "text",
            id_col: str = "doc_id") -> DataFrame:
    """Of each row's encoding: doc_id, number of ids, SHA-256 of the ids in decimal parted by spaces, and of the decoded bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_list(ranks))

    def finish(keys: pa.Array, ids: pa.ListArray) -> dict:
        pieces = shared.value
        piece, numeral = pieces.__getitem__, _numerals(len(pieces)).__getitem__
        counts, own, back = [], [], []
        for x in _id_lists(ids):
            counts.append(len(x))
            own.append(hashlib.sha256(b" ".join(map(numeral, x))).hexdigest())
            back.append(hashlib.sha256(b"".join(map(piece, x))).hexdigest())
        return {"doc_id": keys, "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(own, pa.string()),
                "decoded_sha256": pa.array(back, pa.string())}

    return _encoded(docs, ranks, pattern, None, text_col, id_col,
                    "doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", finish)


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: digests of the ids and of the decoded bytes."""
    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return digests(read_parquet(spark, f"{sf_dir}/documents.parquet"), ranks)
