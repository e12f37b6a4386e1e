import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelens.llm.token_counts import Counter, Vocabulary, count_tokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(Vocabulary.load(PATH), public_tokenizers.PATTERN)


def sizes(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character(library, counter):
    letters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in letters[i:i + 200]) for i in range(0, 0x3100, 200)]
    assert counter(texts) == sizes(library, texts)


def test_random_texts(library, counter):
    pick = random.Random(5)
    pieces = ["the", " ", "  ", "\n", "\t", "é", "'s", "'ll", "12", "...", "aaaa", "x", "　", "\x85", "\x1c", "漢字",
              "🙂", "<|endoftext|>", "<|endof", "Ünglich", "!", "\x00"]
    texts = ["".join(pick.choices(pieces, k=pick.randrange(60))) for _ in range(3000)]
    assert counter(texts) == sizes(library, texts)


def test_long_pre_tokens(library, counter):
    pick = random.Random(6)
    texts = ["a" * 5000, "ab" * 3000, "".join(pick.choices("etaoinshr", k=20000)), "=" * 999, " " * 777]
    assert counter(texts) == sizes(library, texts)


def test_frame(spark, library):
    rows = [(1, "one two", "x", 9), (None, "three", None, 1), (3, None, "x", 2), (4, "", "x", 3), (1, "one two", "x", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    got = sorted((tuple(r) for r in count_tokens(docs, PATH).collect()), key=str)
    assert got == sorted([(1, 7, 2), (None, 5, 1), (3, 0, 0), (4, 0, 0), (1, 7, 2)], key=str)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    for row, n in zip(docs, sizes(library, [r.text or "" for r in docs])):
        assert got[row.doc_id] == (len((row.text or "").encode()), n, n > 512)
    assert len(got) == len(docs)
    assert np.mean([n[1] for n in got.values()]) > 100
