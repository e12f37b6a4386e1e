import random

import numpy as np
import pyarrow as pa

from hirelens.llm import decontaminate as D

LETTERS = "etaoinshrdlu "


def edit_distance_inside(probe, text):
    """Fewest edits between the probe and any region of the text, by the full table."""
    row = np.zeros(len(text) + 1, dtype=int)
    for i, a in enumerate(probe, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, b in enumerate(text, 1):
            new[j] = min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1)
        row = new
    return row.min()


def canon(text):
    content = np.frombuffer(text.encode(), np.uint8)
    return bytes(D.canonical(content, np.array([0, len(content)]))[0])


def edited(text, edits, pick):
    letters = list(text)
    for _ in range(edits):
        at = pick.randrange(len(letters))
        letters[at:at + 1] = pick.choice([[], [letters[at], "x"], ["q"]])
    return "".join(letters)


def test_against_full_alignment():
    pick = random.Random(7)
    item = "".join(pick.choices(LETTERS, k=110)).strip()
    index = D.Index.build([(5, item)], probe_bytes=100, error=0.1, least_bytes=30)
    texts = []
    for k in range(60):
        inner = edited(item, k // 3, pick)
        texts.append("".join(pick.choices(LETTERS, k=30)) + inner + "".join(pick.choices(LETTERS, k=pick.randrange(40))))
    texts += ["", None, "short", item, item[:60], item.upper().replace(" ", ",\n")]
    rows, probe, edits, start, stop = D.matches(index, pa.array(texts))
    got = {(r, p): e for r, p, e in zip(rows.tolist(), probe.tolist(), edits.tolist())}
    for k, text in enumerate(texts):
        for p in range(len(index.sizes)):
            pattern = bytes(index.letters[p, :index.sizes[p]])
            best = edit_distance_inside(pattern, canon(text or ""))
            if best <= index.budgets[p]:
                assert got[(k, p)] <= index.budgets[p]
                assert got[(k, p)] >= best
            else:
                assert (k, p) not in got


def test_places_are_in_the_original():
    index = D.Index.build([(1, "the quick brown fox jumps over the lazy dog again")], 100, 0.1, 30)
    text = "Zé --- The  QUICK brown, fox\njumps over the lazy dog again!! end"
    rows, _, edits, start, stop = D.matches(index, pa.array([text]))
    assert (rows.tolist(), edits.tolist()) == ([0], [0])
    assert text.encode()[start[0]:stop[0]].strip() == b"The  QUICK brown, fox\njumps over the lazy dog again"


def test_frames(spark):
    passage = "".join(random.Random(1).choices("abcdefghij ", k=150))
    clean = "".join(random.Random(2).choices("klmnopqrst ", k=150))
    rows = [(1, f"{clean} {passage} {clean}", "e"), (None, passage, "e"), (3, clean, "e"), (4, None, "e"), (5, "", "e"), (3, clean, "e"),
            (6, passage, "e"), (6, passage, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits string")
    items = [(9, passage, "s"), (9, passage, "s"), (8, None, "s"), (7, "", "s"), (None, "x" * 50, "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string, start string")
    for block in (1 << 20, 100):
        found = D.find(docs, benchmark, block_bytes=block).select("doc_id", "item_id").distinct().collect()
        assert {tuple(r) for r in found} == {(1, 9), (None, 9), (6, 9)}
        kept = D.clean_rows(docs, benchmark, block_bytes=block)
        assert sorted(r.doc_id for r in kept.collect()) == [3, 3, 4, 5] and kept.columns == docs.columns
    assert D.find(docs, benchmark.limit(0)).count() == 0 and D.clean_rows(docs, benchmark.limit(0)).count() == 8
    assert D.find(docs.limit(0), benchmark).count() == 0


def test_documents_against_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in D.decontamination(spark, folder).collect()}
    docs = [(r.doc_id, canon(r.text or "")) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, canon(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = {(i, k) for k, t in items for i, text in docs if t.strip() in text}
    assert whole and whole <= got and len(got) <= len(whole) + 2


def test_a_phrase_of_very_many_items(monkeypatch):
    """Hits are counted in pieces, and the pieces change nothing."""
    import pyarrow as pa

    from hirelens.llm import decontaminate as D
    pick = random.Random(11)
    word = lambda: "".join(pick.choices("abcdefghijklmnop", k=6))
    phrase = "answer the following question about the passage"
    items = [(k, f"{' '.join(word() for _ in range(6))} {phrase} {' '.join(word() for _ in range(8))}") for k in range(300)]
    index = D.Index.build(items, 100, 0.1, 30)
    filler = [" ".join(word() for _ in range(5)) for _ in range(10)]
    texts = [" ".join(f"{phrase} {f}" for f in filler)] * 3 + [f"{word()} {items[k][1]} {word()}" for k in range(0, 300, 50)] + ["", None]
    assert D.shared_qgrams(index, *D.canonical(*D.text_buffer(pa.array(texts)))[::2]).many.sum() > 200_000
    plain = None
    for at_once in (1 << 40, 20_000):
        monkeypatch.setattr(D, "HITS_AT_ONCE", at_once)
        (rows, probe, edits, start, stop), others = D.search(index, pa.array(texts))
        found = [x.tolist() for x in (rows, probe, edits, start, stop, *others)]
        assert plain is None or found == plain
        plain = found
    pairs = set(zip(rows.tolist(), index.items[probe].tolist()))
    assert pairs >= {(3 + n, k) for n, k in enumerate(range(0, 300, 50))} and not {p for p in pairs if p[0] < 3}


def test_memory_of_a_search_does_not_grow_with_the_batch():
    import tracemalloc

    pick = random.Random(5)
    words = ["".join(pick.choices(LETTERS.strip(), k=6)) for _ in range(2000)]
    items = [(k, " ".join(pick.choices(words, k=30))) for k in range(50)]
    index = D.Index.build(items, 100, 0.1, 30)
    texts = [" ".join(pick.choices(words, k=300)) for _ in range(1500)]
    texts[7] = texts[1400] = f"{texts[0]} {items[3][1]} {texts[1]}"
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    class shared:
        value = index

    tracemalloc.start()
    kept = [t for part in D._cleaner(shared, "text")(iter([batch])) for t in part.column("text").to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == [t for k, t in enumerate(texts) if k not in (7, 1400)]
    assert most < 60 << 20
