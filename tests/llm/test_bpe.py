import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hirelens.llm.bpe import bpe, decode, encode, encode_decoded, load_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(spark, ranks, library):
    pick = random.Random(3)
    pieces = ["the", " ", "  ", "\n", "\t", "é", "'s", "'ll", "12", "...", "aaaa", "x", "　", "\x85", "\x1c", "漢字", "🙂",
              "<|endoftext|>", "Ünglich", "!", "\x00", "anthropology", "Ā"]
    texts = ["".join(pick.choices(pieces, k=pick.randrange(40))) for _ in range(400)]
    texts += ["a" * 300, "ab" * 150, "".join(pick.choices("etaoinshr", k=400)), "", "=" * 99, " " * 77]
    texts += ["".join(pick.choices("ab", k=40)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = encode(docs, ranks).select("key", "ids", decode(F.col("ids"), ranks).alias("back")).collect()
    assert len(got) == len(texts)
    for row in got:
        assert row.ids == library.encode_ordinary(texts[row.key]), texts[row.key]
        assert bytes(row.back) == texts[row.key].encode()


def test_words_numbered_across_batches(spark, ranks, library):
    pick = random.Random(5)
    words = ["".join(pick.choices("etaoinshr", k=pick.randrange(1, 9))) for _ in range(60)]
    texts = [" ".join(pick.choices(words, k=pick.randrange(30))) for _ in range(120)] + [None] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    # Many batches a task; numbers begin anew never, now and then, and with each batch.
    for most_words in (10**6, 40, 0):
        got = {r.key: r.ids for r in encode(docs, ranks, batch_bytes=500, most_words=most_words).collect()}
        assert got == {k: library.encode_ordinary(t or "") for k, t in enumerate(texts)}


def test_nulls_repeats_and_extra_columns(spark, ranks):
    rows = [(1, None, "k"), (None, "one", "k"), (2, "", "k"), (2, "one", "k"), (2, "one", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = sorted(((r.key, r.ids) for r in encode(docs, ranks).collect()), key=str)
    assert got == sorted([(1, []), (None, [505]), (2, []), (2, [505]), (2, [505])], key=str)
    assert encode(docs.limit(0), ranks).count() == 0


def test_one_very_long_word(spark, ranks, library):
    pick = random.Random(4)
    texts = ["".join(pick.choices("etaoinshrdlu", k=5000)), "a" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r for r in encode_decoded(docs, ranks).collect()}
    for k, text in enumerate(texts):
        assert got[k].ids == library.encode_ordinary(text) and bytes(got[k].decoded) == text.encode()


def test_unknown_ids_have_no_text(spark, ranks):
    docs = spark.createDataFrame([([70000],), ([-1],), ([],), (None,)], "ids array<long>")
    assert [r[0] for r in docs.select(decode(F.col("ids"), ranks)).collect()] == [None, None, bytearray(), None]


def test_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids, found = library.encode_ordinary(row.text or ""), got[row.doc_id]
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
