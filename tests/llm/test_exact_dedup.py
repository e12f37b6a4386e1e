import random
import re

from pyspark.sql import functions as F

from hirelens.llm import exact_dedup as E

SCHEMA = "doc_id long, text string, place string, digest int, best string, kept string"


def with_extras(rows):
    return [(i, t, "x", 1, "y", "z") for i, t in rows]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for members in groups.values():
        keep = min(members)[3]
        out += [(m[3], keep, len(members)) for m in members]
    return sorted(out, key=str)


def test_random_rows_with_nulls_ties_and_repeats(on_file):
    pick = random.Random(1)
    rows = [(k, "".join(pick.choices("ab \t\n\x0b\x0c\r\x85", k=pick.randrange(4)))) for k in range(300)]
    rows += [(None, "ab"), (500, None), (501, ""), (7, rows[7][1]), (502, "é " * 50), (503, "é" * 50)]
    found = E.dedup(on_file(with_extras(rows), SCHEMA, files=3)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({bytes(r.digest) for r in found})


def test_weak_digests_never_merge_different_texts(on_file):
    rows = [(k, f"text {k % 40}") for k in range(200)]
    weak = lambda text: F.pmod(F.length(text), F.lit(2)).cast("string").cast("binary")
    found = E.dedup(on_file(with_extras(rows), SCHEMA, files=2), digest=weak).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute(rows)


def test_state_over_many_batches(on_file):
    rows = [(k, f"text {k % 15}" + " " * (k % 7)) for k in range(120)]
    found = E.dedup(on_file(with_extras(rows), SCHEMA, files=6), files_per_batch=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute(rows)


def test_empty_table_and_kept_rows(on_file):
    assert E.dedup(on_file([], SCHEMA)).count() == 0
    docs = on_file(with_extras([(1, "a b"), (2, "ab"), (3, "c")]), SCHEMA, name="u")
    assert sorted(r.doc_id for r in E.kept_rows(docs).collect()) == [1, 3]
    assert E.kept_rows(docs).columns == docs.columns
