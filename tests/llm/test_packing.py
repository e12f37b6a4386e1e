import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hirelens.llm.packing import Encoder, OpenSequences, best_fit, count_up, cut, packing, place, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder.load(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def one_by_one(lengths, capacity):
    """Remaining capacities after best fit decreasing, a piece at a time."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(capacity - length)
    return sorted(room)


def laid_out(plan, lengths):
    """Remaining capacity of each sequence; checks that pieces lie without gaps."""
    held = defaultdict(list)
    for length, count in Counter(lengths).items():
        where = plan.place(np.full(count, length), np.arange(count))
        for sequence, offset in zip(*where):
            held[int(sequence)].append((int(offset), length))
    assert sorted(held) == list(range(plan.sequences))
    filled = []
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        filled.append(end)
    return filled


def test_segment_tree_finds_the_tightest():
    pick = random.Random(1)
    for capacity in (1, 2, 7, 8, 9, 100):
        open_, held = OpenSequences(capacity), Counter()
        for k in range(300):
            length = pick.randint(1, capacity)
            assert open_.tightest(length) == min((r for r in held if held[r] and r >= length), default=0)
            if pick.random() < 0.6:
                open_.put(length, k, 1)
                held[length] += 1
            elif held[length]:
                open_.take(length)
                held[length] -= 1


@pytest.mark.parametrize("capacity", [1, 5, 16, 64, 200])
def test_plan_equals_one_piece_at_a_time(capacity):
    pick = random.Random(capacity)
    for size in (1, 10, 300):
        for low in (1, max(1, capacity // 3)):
            lengths = [pick.randint(low, capacity) for _ in range(size)] + [capacity // 2 + 1] * (size // 3)
            lengths = [x for x in lengths if x <= capacity]
            plan = best_fit(Counter(lengths), capacity)
            filled = laid_out(plan, lengths)
            assert max(filled) <= capacity
            assert sorted(capacity - f for f in filled) == one_by_one(lengths, capacity)


def test_plan_does_not_grow_with_the_pieces():
    sizes = [len(best_fit({k: n * (k % 7 + 1) for k in range(1, 257)}, 256).key) for n in (10, 10_000, 10_000_000)]
    assert max(sizes) < 3 * min(sizes) and max(sizes) < 256 * 16


def test_count_up():
    seen = np.zeros(9, dtype=np.int64)
    assert count_up(np.array([3, 1, 3, 3]), seen).tolist() == [0, 0, 1, 2]
    assert count_up(np.array([1, 3, 8]), seen).tolist() == [1, 3, 0]


def test_ids_equal_the_library(library, encoder):
    encoding = encoder.build()
    letters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in letters[i:i + 200]) for i in range(0, 0x3100, 200)]
    pick = random.Random(5)
    pieces = ["the", " ", "  ", "\n", "\t", "é", "'s", "12", "...", "aaaa", "x", "　", "\x85", "\x1c", "漢字", "🙂",
              "<|endoftext|>", "<|endof", "!", "\x00"]
    texts += ["".join(pick.choices(pieces, k=pick.randrange(60))) for _ in range(2000)]
    texts += ["a" * 50_000, " " * 50_000, "ab" * 50_000, "\n " * 20_000 + "x", "é" * 50_000]
    for text in texts:
        assert encoding.encode_to_numpy(text, allowed_special="all").tolist() + [0] == ids_of(library, text)


ROWS = [(1, "one two three", 5, "x"), (2, None, 6, "x"), (3, "", 7, "x"), (None, "a null identifier", 8, None),
        (1, "one two three", 5, "x"), (4, "word " * 100, 1, "x"), (5, "<|endoftext|> inside", 1, "y"),
        (6, "b" * 3000, 1, "z")] + [(k, "the same text of a hot group", 1, "h") for k in range(10, 60)]
SCHEMA = "doc_id long, text string, offset int, task string"


def test_pieces_and_places(spark, library, encoder):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    placed = place(cut(docs, encoder, capacity=16), capacity=16)
    rows = placed.collect()
    assert placed.columns == ["key", "piece", "start", "length", "ids", "sequence_id", "offset"]
    got, wanted = defaultdict(list), Counter()
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= 16
        got[r.key].append((r.piece, r.start, ids))
    for key, text, *_ in ROWS:
        wanted[key] += 1
    for key, n in wanted.items():
        ids = next(ids_of(library, t) for k, t, *_ in ROWS if k == key)
        head = len(ids) % 16 or 16
        cuts = [ids] if len(ids) <= 16 else [ids[:head]] + [ids[a:a + 16] for a in range(head, len(ids), 16)]
        want = [(p, sum(map(len, cuts[:p])), part) for p, part in enumerate(cuts)]
        assert sorted(got[key]) == sorted(want * n)
    lengths = [r.length for r in rows]
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
    assert sorted(16 - sum(n for _, n in p) for p in used.values()) == one_by_one(lengths, 16)
    whole = {r.sequence_id: r.ids for r in sequences(placed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == r.ids


def test_empty_table(spark, encoder):
    docs = spark.createDataFrame([], SCHEMA)
    assert place(cut(docs, encoder)).count() == 0


def test_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = packing(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    lengths = []
    for doc in docs:
        ids = ids_of(library, doc.text)
        start = 0
        for piece in range(-(-len(ids) // 2048)):
            r = pieces.pop((doc.doc_id, piece))
            part = ids[start:start + r.length]
            assert r.start == start and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r.length == 2048 or piece == 0
            start += r.length
            lengths.append(r.length)
        assert start == len(ids)
    assert not pieces
    assert len({r.sequence_id for r in rows}) == len(one_by_one(lengths, 2048))
