import unicodedata
from datetime import datetime

from pyspark.sql import functions as F

from hirelens.functions.text import nfkc_list
from hirelens.operators.clean import check, clean, keep_first, split_valid
from hirelens.operators.enrich import enrich, fill_entities
from hirelens.plans.batch import process_raw
from hirelens.schemas import RAW_POSTING

def seen():
    return F.lit("2026-03-01 12:00:00").cast("timestamp")


def raw(spark, *rows):
    names = [f.name for f in RAW_POSTING.fields]
    full = [tuple({"ordinal": i, **r}.get(n) for n in names) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, RAW_POSTING)


def test_untitled_rows_go_and_duplicates_keep_the_first(spark):
    rows = raw(
        spark,
        {"source": "s", "title": " Data  Lead ", "company": "Beta", "location": "oslo", "url": "https://b.test/1", "description": "one"},
        {"source": "s", "title": "Data Lead", "company": "BETA ", "location": "Oslo", "url": "https://b.test/1", "description": "two"},
        {"source": "s", "title": " \t ", "company": "Nobody"},
        {"source": None, "title": "Analyst", "company": "Beta", "url": "javascript:x"},
    )
    got = keep_first(clean(rows, seen())).orderBy("ordinal").collect()
    assert [(r.title, r.description) for r in got] == [("Data Lead", "one"), ("Analyst", None)]
    assert got[1].source == "unknown" and got[1].url is None
    assert all(len(r.job_id) == 16 for r in got)
    shuffled = keep_first(clean(rows.repartition(7, "title"), seen())).orderBy("ordinal").collect()
    assert shuffled == got


def test_hot_duplicate_keeps_the_first(spark):
    """One posting holds most rows; the survivor is still the earliest."""
    many = spark.range(20000).select(
        F.col("id").alias("ordinal"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, F.concat_ws(" ", F.lit("Job"), "id")).otherwise(F.lit("Same Job")).alias("title"),
        F.col("id").cast("string").alias("description"),
    ).repartition(8)
    got = keep_first(clean(many, seen()))
    assert got.count() == 6667 + 1
    assert got.filter("title = 'Same Job'").first().description == "1"


def test_long_titles_are_cut(spark):
    row = clean(raw(spark, {"title": "t" * 300}), seen()).first()
    assert len(row.title) == 200 and row.title.endswith("…")


def test_rules(spark):
    rows = spark.createDataFrame(
        [("a", "s", " ok ", True, "100", "-5", ["x"], datetime(2026, 1, 1)),
         ("b", "s", " ", None, "ten", None, None, None),
         ("c", "s", "t", False, "nan", None, None, datetime(2026, 1, 1)),
         (None, None, None, False, "0", "7", [], datetime(2026, 1, 1))],
        "job_id string, source string, title string, remote boolean, salary_min string, salary_max string, "
        "skills array<string>, scraped_at timestamp",
    )
    got = {r.job_id: r for r in check(rows).collect()}
    assert got["a"].violations == [] and got["a"].title == "ok"
    assert (got["a"].salary_min, got["a"].salary_max) == (100.0, None)
    assert got["b"].violations == ["title_blank", "remote_missing", "salary_min_not_number", "scraped_at_missing"]
    assert got["c"].violations == [] and got["c"].salary_min is None and got["c"].skills == []
    assert got[None].violations == ["job_id_missing", "source_missing", "title_blank"]
    valid, bad = split_valid(rows)
    assert valid.count() == 2 and bad.count() == 2


def test_enrich(spark):
    rows = raw(spark, {
        "title": "Senior ML Engineer", "company": "Beta", "location": "Lyon",
        "description": "Beta | Senior ML Engineer | REMOTE | $150k-$180k\nWe use Python, PyTorch and Docker.",
    })
    got = enrich(clean(rows, seen())).first()
    assert got.skills == ["Python", "PyTorch", "Docker", "Machine Learning"]
    assert (got.salary_min, got.salary_max, got.salary_currency) == (150000.0, 180000.0, "USD")
    assert got.remote and got.seniority == "Senior"


def test_remote_offer_deep_in_the_text_does_not_count(spark):
    rows = raw(spark, {"title": "Dev", "description": "x" * 400 + " remote"}, {"title": "Dev2", "description": "y " * 190 + "remote"})
    got = enrich(clean(rows, seen())).orderBy("ordinal").collect()
    assert [r.remote for r in got] == [False, True]


def test_gaps_are_filled_from_the_first_entity(spark):
    rows = raw(
        spark,
        {"title": "Dev", "description": "We at Acme Corp, near Oslo; also Beta in New York."},
        {"title": "Dev", "company": "Own", "description": "Beta (New York) or Oslo"},
        {"title": "Dev", "company": "Full", "location": "Rome", "description": "Beta, Oslo"},
        {"title": "Dev", "company": "None", "description": "x" * 600 + " Oslo"},
    )
    names = spark.createDataFrame(
        [("Acme Corp", "ORG"), ("Beta", "ORG"), ("Oslo", "GPE"), ("New York", "GPE"), ("York", "GPE")], "name string, kind string"
    )
    cleaned = clean(rows, seen())
    got = {r.ordinal: (r.company, r.location) for r in fill_entities(cleaned, names).collect()}
    assert got == {0: ("Acme Corp", "Oslo"), 1: ("Own", "New York"), 2: ("Full", "Rome"), 3: ("None", None)}
    ids = {r.ordinal: r.job_id for r in cleaned.collect()}
    assert ids == {r.ordinal: r.job_id for r in fill_entities(cleaned, names).collect()}


def test_process_counts(spark):
    rows = raw(spark, {"title": "Go Dev"}, {"title": "go dev"}, {"title": " "}, {"title": "Python Dev"})
    done = process_raw(rows, seen())
    assert done.valid.count() == 2
    assert done.counts() == {"fetched": 4, "unique": 2, "with_skills": 2, "valid": 2, "invalid": 0}
    assert done.quarantine.count() == 0


def test_entities_of_any_number_of_words(spark):
    rows = [(1, "works in United States of America now"), (2, "United States"), (3, "United States of Americana")]
    raw = spark.createDataFrame(rows, "ordinal long, description string").withColumn("title", F.col("ordinal").cast("string"))
    names = spark.createDataFrame([("United States of America", "GPE"), ("United States", "GPE")], "name string, kind string")
    got = {r.ordinal: r.location for r in fill_entities(clean(raw), names).collect()}
    assert got == {1: "United States of America", 2: "United States", 3: "United States"}


def test_all_texts_of_a_posting_go_to_python_as_one_column(spark):
    names = ["source", "title", "company", "location", "posted", "url", "description"]
    texts = [("s", "ﬁne​  job", None, "Ａ", "", "http://x", "Ⅷ\x85 a–b\x1cq "), (None, "é – x", "a\x7fb", "　", "x", "y", "é  é")]
    raw = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], ", ".join(["ordinal int", *(f"{n} string" for n in names)]))
    cleaned = clean(raw, F.lit("2026-01-01").cast("timestamp"))
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("batch(") == 1
    rows = {r.ordinal: r for r in cleaned.collect()}
    assert [rows[0][n] for n in ("source", "title", "company", "location", "url", "description")] == [
        "s", "fine job", None, "A", "http://x", "VIII a–b q"]
    assert [rows[1][n] for n in ("source", "title", "company", "location", "description")] == ["unknown", "é – x", "a\x7fb", None, "é é"]


def test_cleaning_forbids_methods_that_the_jvm_never_compiles(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    for before, after in ((65535, "8000"), (4000, "4000")):
        spark.conf.set(limit, before)
        clean(spark.createDataFrame([], RAW_POSTING))
        assert spark.conf.get(limit) == after
    spark.conf.unset(limit)


def test_texts_go_to_python_as_one_string(spark):
    rows = [("ﬁne \"q\" \\", None, "①\u0001\n", "plain"), ("é", "café", None, ""), (None, None, None, None),
            ("\U0001d518", "é", "ガ", "\x00ﬀ"), ("'[1, null]", "{}", " ａ", "null")]
    texts = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string, d string")
    found = texts.withColumn("n", nfkc_list([F.col(c) for c in "abcd"]))
    got = {r.i: tuple(t if r.n is None or r.n[k] is None else r.n[k] for k, t in enumerate(r[1:5])) for r in found.collect()}
    assert got == {i: tuple(t and unicodedata.normalize("NFKC", t) for t in r) for i, r in enumerate(rows)}
    # Arrow lists cost several times what strings do.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan
