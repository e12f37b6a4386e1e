import re

import corpus_pipeline
from hirelens.llm.decontaminate import canonical
from test_jaccard_join import shingles

import numpy as np

FOLDER = "/root/testdata/sf0.001"


def canon(text):
    content = np.frombuffer(text.encode(), np.uint8)
    return bytes(canonical(content, np.array([0, len(content)]))[0]).strip()


def held_parts(item):
    """What must not occur in a document: an item as a whole, 60 bytes of it, 13 words of it."""
    words = item.split(b" ")
    return {item, *(item[k:k + 60] for k in range(len(item) - 59)),
            *(b" " + b" ".join(words[k:k + 13]) + b" " for k in range(len(words) - 12))}


def test_stages_against_plain_rules(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = [canon(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [d for d in docs.values() if re.search(r"[^\W\d_]", d.text or "")]
    seen, unique = set(), []
    for d in sorted(left, key=lambda d: (-len(d.text), d.doc_id)):
        key = re.sub(r"[\x20\x09-\x0D]", "", d.text)
        if key not in seen:
            unique.append(d)
        seen.add(key)
    sets, label = {d.doc_id: shingles(d.text, 5) for d in unique}, {d.doc_id: d.doc_id for d in unique}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    parts = set().union(*map(held_parts, items))
    want = {i for i in ids if top(i) == i and not any(part in b" " + canon(docs[i].text) + b" " for part in parts)}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    for r in rows:
        assert r.decoded == docs[r.doc_id].text and r.n_tokens == len(r.ids)


def test_odd_rows_through_all_stages(spark, tmp_path):
    """Nulls, empty and repeated rows, further columns; then an empty table."""
    import shutil
    for folder, rows in (("odd", True), ("empty", False)):
        (tmp_path / folder).mkdir()
        shutil.copy(f"{FOLDER}/benchmark.parquet", tmp_path / folder)
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150 if rows else 0)
        odd = spark.createDataFrame(
            [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "\n\t ", "en", "s", 3), (None, "?!", "de", None, 2)], docs.schema)
        every = docs.unionByName(docs.limit(20)).unionByName(odd) if rows else docs
        every.selectExpr("*", "1 AS ids", "'x' AS decoded", "'y' AS key").write.parquet(str(tmp_path / folder / "documents.parquet"))
        got = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / folder)).collect()]
        assert len(got) == len(set(got)) and None not in got and bool(got) == rows


def test_stages_hand_on_the_columns(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
