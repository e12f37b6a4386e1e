import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hirelens.llm import toxicity as T


def test_ngrams_against_plain_search():
    texts = ["Abc defgh, ij", "", "xy", "abc defgh", "é" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    rows, codes = T.found(batch, np.ones(1 << T.BITS, dtype=bool))
    plain = set()
    for k, text in enumerate(texts):
        data = bytes(T.LETTERS[np.frombuffer(text.encode(), np.uint8)])
        plain |= {(k, int.from_bytes(data[i:i + n], "big")) for n in T.LENGTHS for i in range(len(data) - n + 1)}
    assert set(zip(rows.tolist(), codes.tolist())) == plain and len(rows) == len(plain)


def test_counts_against_plain_counting(spark):
    sample = spark.createDataFrame([("abcdef", True), ("abcdxx", False), ("abcd abcd", True)], "text string, bad boolean")
    code = int.from_bytes(b"abcd", "big")
    got = T.ngram_frequencies(sample, np.ones(1 << T.BITS, dtype=bool)).where(F.col("code") == code).first()
    assert (got.bad, got.good) == (2, 1)


def test_planted_words_are_learnt(spark):
    pick = random.Random(9)
    words = ["thor", "and", "lest", "wind", "sea", "oner", "stone", "green"]
    rows = []
    for k in range(600):
        bad = k % 5 == 0
        text = pick.choices(words, k=40) + ([pick.choice(["grubworm", "nastyhead"])] if bad else [])
        pick.shuffle(text)
        rows.append((k, " ".join(text), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = T.labelled_sample(docs.where("doc_id < 400"), docs.where("doc_id < 400"), "doc_id", "text", "doc_id", "toxic", 1000)
    got = {r.doc_id: r for r in T.score_texts(docs, T.train(sample)).collect()}
    assert all(got[k].predicted == bad for k, _, bad in rows if k >= 400)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "", 0.5), (2, "x", 0.5), (2, "x", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 1), (None, 0)], "doc_id long, toxic int")
    for marked in (labels, labels.limit(0)):
        model = T.train(T.labelled_sample(docs, marked, "doc_id", "text", "doc_id", "toxic", 10))
        got = T.score_texts(docs, model).collect()
        assert len(got) == 4 and len({r.score for r in got}) == 1
        assert T.score_texts(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = T.toxicity(spark, folder).where("held_out").join(labels, "doc_id").toPandas()
    right = (held.predicted == 1) & (held.toxic == 1)
    assert right.sum() / (held.predicted == 1).sum() > 0.85
    assert right.sum() / (held.toxic == 1).sum() > 0.8


def test_one_row_of_a_repeated_identifier(spark):
    from hirelens.llm.toxicity import labelled_sample
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(3000)] + [(k, f"other {k}") for k in range(2, 60)] + [(7, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "doc_id", "text", "doc_id", "toxic", 100).collect()
    assert len(rows) == 59 and sum((r.text or "").startswith("text") for r in rows) == 1
