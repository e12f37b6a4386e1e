import hashlib
import random
import re

import pytest

from hirelens.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, n_words string, start string, kept int"


def brute(docs, window):
    """docs: {(id, text)}; every window against the windows that start earlier."""
    seen, out = set(), {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            here = tuple(words[s:s + window])
            if here in seen:
                gone[s:s + window] = [True] * window
            seen.add(here)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def run(spark, rows, window):
    docs = spark.createDataFrame([(i, t, "n", "s", 1) for i, t in rows], SCHEMA)
    return {r.doc_id: tuple(r)[1:] for r in S.dedup_substrings(docs, window=window).collect()}


def test_automaton_against_plain_search():
    pick = random.Random(1)
    for _ in range(200):
        automaton, before = S.Automaton(), []
        for _ in range(5):
            words = [pick.randrange(2) for _ in range(pick.randrange(1, 14))]
            for j, got in enumerate(automaton.stream(words)):
                best = 0
                for n in range(1, j + 2):
                    part = words[j + 1 - n:j + 1]
                    if any(w[x:x + n] == part for w in before for x in range(len(w))) or any(words[x:x + n] == part for x in range(j + 1 - n)):
                        best = n
                assert got == best
            before.append(words)


@pytest.mark.parametrize("letters,window", [("ab", 6), ("abc", 8), ("abcdefghij", 6), ("a", 20)])
def test_random_texts(spark, letters, window):
    pick = random.Random(window)
    shared = [pick.choices(letters, k=30) for _ in range(4)]
    rows = []
    for k in range(80):
        words = pick.choices(letters, k=pick.randrange(30))
        for _ in range(pick.randrange(3)):
            words += pick.choice(shared)[pick.randrange(8):] + pick.choices(letters, k=pick.randrange(6))
        rows.append((k, pick.choice([" ", "\n", "\t\x0b "]).join(words)))
    assert run(spark, rows, window) == brute(rows, window)


def test_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(S, "WIDE", 2)
    monkeypatch.setattr(S, "SHARD_WORDS", 50)
    pick = random.Random(5)
    line = [f"w{k}" for k in range(12)]
    rows = [(k, " ".join([*pick.choices("abc", k=9), *line, *pick.choices("abc", k=9)])) for k in range(60)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_nulls_and_repeats(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (5, text), (9, text + " end"), (None, text), (7, None), (8, ""), (6, "x\x85y \x1fz")]
    docs = spark.createDataFrame([(i, t, "n", "s", 1) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.dedup_substrings(docs).collect()), key=str)
    want = [(5, 30, 0, text), (5, 30, 0, text), (9, 31, 30, "end"), (None, 30, 0, text), (7, 0, 0, ""), (8, 0, 0, ""),
            (6, 2, 0, "x\x85y \x1fz")]
    assert got == sorted(want, key=str)
    assert S.dedup_substrings(docs.limit(0)).count() == 0


def test_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in brute(docs, 20).items()}
    assert {r.doc_id: tuple(r)[1:] for r in S.substring_dedup(spark, folder).collect()} == want
