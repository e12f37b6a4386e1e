from hirelens.llm import language_id as L


def test_no_language_is_crowded_out_of_the_sample(spark):
    rows = [(None, f"aa {k} first words", "a") for k in range(300)] + [(5, f"bb {k} other words", "b") for k in range(300)]
    rows += [(1000 + k, f"cc {k} last words", "c") for k in range(8)] + [(None, "again", "a")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    sample = L.labelled_sample(docs, "text", "lang", "doc_id", 10, 600)
    sizes = {lang: sum(1 for name, _ in sample if name == lang) for lang in "abc"}
    assert sizes["c"] == 8 and 5 <= sizes["a"] <= 10 and 5 <= sizes["b"] <= 10 and len(set(sample)) == len(sample)
