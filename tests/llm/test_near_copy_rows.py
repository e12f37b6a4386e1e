import corpus_pipeline
from hirelens.llm import jaccard_join as J

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_copies_are_judged_by_row(spark, on_file):
    rows = [(3, "a b"), (4, "A  B"), (6, ""), (9, "a b c"), (9, "a b c"), (2, "x y z"), (2, "p q r"), (10, "P q R"), (11, None),
            (None, "a b"), (None, "k l m"), (None, "n o")] + [(7, f"hot words number {k}") for k in range(20)]
    docs = on_file([(i, t, "en", "s", 1) for i, t in rows], COLUMNS, files=3)
    want = [(3, "a b"), (6, ""), (9, "a b c"), (2, "x y z"), (2, "p q r"), (11, None), (None, "k l m"), (None, "n o")] + rows[12:]
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert kept.columns == docs.columns and J.kept_rows(docs.limit(0)).count() == 0
