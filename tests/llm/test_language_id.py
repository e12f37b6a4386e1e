import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hirelens.llm import language_id as L
from hirelens.llm.common import remainder


def test_gradients_against_differences():
    net, draw = L.Network.start(["a", "b", "c"]), np.random.default_rng(0)
    letters = draw.integers(97, 105, size=(12, 5)).astype(np.uint8)
    lengths, targets = np.array([12, 12, 7, 3, 12]), draw.integers(3, size=5)
    _, found = L.gradients(net, letters, lengths, targets)
    for weights, gradient in zip(net.parts(), found):
        for _ in range(5):
            at = tuple(draw.integers(s) for s in weights.shape)
            before = weights[at]
            weights[at] = before + 0.02
            high = L.gradients(net, letters, lengths, targets)[0]
            weights[at] = before - 0.02
            low = L.gradients(net, letters, lengths, targets)[0]
            weights[at] = before
            assert abs((high - low) / 0.04 - gradient[at]) < 2e-3


def test_windows_hold_every_byte_once():
    content = np.arange(250, dtype=np.uint8)
    letters, lengths, rows = L.windows(content, np.array([0, 0, 1, 120, 250]), width=32)
    seen = [letters[t, k] for k in range(letters.shape[1]) for t in range(lengths[k])]
    assert seen == list(range(250))
    assert np.bincount(rows, weights=lengths, minlength=4).tolist() == [0, 1, 119, 130]


def test_probabilities_are_means_over_all_positions():
    net = L.Network.start(["a", "b"])
    text = "some words " * 40
    letters, lengths, _ = L.windows(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    letters = np.where(np.arange(L.WINDOW)[:, None] < lengths[None, :], letters, 32).astype(np.uint8)
    p = net.positions(net.states(letters))
    plain = np.concatenate([p[:n, k] for k, n in enumerate(lengths)]).mean(axis=0)
    assert np.allclose(L.document_scores(net, pa.array([text]))[0], plain, atol=1e-5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = L.language_id(spark, folder).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
                                       F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert held.right > 0.97 and 0 <= held.low and held.high <= 1
    assert found.where(F.col("held_out") != (remainder("doc_id", 3) == 1)).count() == 0
    assert found.count() == docs.count()


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", "x", 5), (2, "der Hund und die Katze", "de", "x", 5), (None, None, None, "x", 5),
            (3, "", "en", "x", 5), (4, "12 !?", "de", "x", 5), (1, "the cat and the dog", "en", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score int")
    got = L.identify(docs, L.learn(docs)).collect()
    assert len(got) == 6
    for r in got:
        assert (r.lang_pred == "und") == (r.text in (None, "", "12 !?")) and 0 <= r.score <= 1
    assert {r.lang_pred for r in L.identify(docs, L.learn(docs.where("lang IS NULL"))).collect()} == {"und"}
    assert L.identify(docs.limit(0), L.learn(docs)).count() == 0
