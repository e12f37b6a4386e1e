import random

import numpy as np
import pyarrow as pa

from hirelens.llm import decontaminate as D

PICK = random.Random(3)
WORDS = ["".join(PICK.choices("abcdefghijklm", k=PICK.randrange(1, 10))) for _ in range(60)]
OTHER = " ".join("".join(PICK.choices("nopqrstuvwxyz", k=5)) for _ in range(40))


def found(index, texts):
    probed, others = D.search(index, pa.array(texts))
    return [set(zip(probed[0].tolist(), index.items[probed[1]].tolist())), set(zip(others[0].tolist(), others[1].tolist()))], others


def test_verbatim_parts_at_every_offset():
    index = D.Index.build([(5, " ".join(WORDS)), (6, OTHER[:120])], 100, 0.1, 30)
    texts = [f"{OTHER[130:]} {' '.join(WORDS[k:k + n]).upper()}, {OTHER[130:]}" for n in (13, 16, 25) for k in range(len(WORDS) - n + 1)]
    texts += [" ".join(["a"] * 30), OTHER[130:], "", None, " ".join(WORDS[:5])]
    pairs, others = found(index, texts)
    assert pairs[0] | pairs[1] == {(k, 5) for k in range(len(texts) - 5)}
    for row, _, _, start, stop in zip(*(x.tolist() for x in others)):
        assert D.canonical(np.frombuffer(texts[row][start:stop].encode(), np.uint8), np.array([0, stop - start]))[0].tobytes().decode().strip() in " ".join(WORDS)


def test_one_letter_words_and_bytes_without_words():
    letters = [PICK.choice("abcdefgh") for _ in range(40)]
    wide = "".join(PICK.choices("äöüßéè", k=60))
    index = D.Index.build([(1, " ".join(letters)), (2, wide)], 100, 0.1, 30)
    texts = ["x " + " ".join(letters[k:k + 13]) + " y" for k in range(28)] + [wide[k:k + 34] for k in range(20)] + [wide[3:20]]
    pairs, _ = found(index, texts)
    assert pairs[0] | pairs[1] == {(k, 1) for k in range(28)} | {(k, 2) for k in range(28, 48)}


def test_short_items_as_whole_words(spark):
    items = [(1, "Yes, sir!"), (2, "forty-two thousand"), (3, "x"), (4, "?!"), (5, "forty-two thousands")]
    texts = ["... yes  SIR", "yes sirs", "eyes sir", "a forty two thousand b forty two thousand", "x", "ax xa", "", None, "sir yes", "forty two thousands"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.probe, r.probes, r.edits, r.start, r.stop) for r in D.find(docs, benchmark).collect()}
    assert got == {(0, 1): (None, 0, 0, 4, 12), (3, 2): (None, 0, 0, 2, 41), (4, 3): (None, 0, 0, 0, 1), (9, 5): (None, 0, 0, 0, 19)}
    assert sorted(r.doc_id for r in D.clean_rows(docs, benchmark).collect()) == [1, 2, 5, 6, 7, 8]
