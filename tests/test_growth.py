"""Steps that must not gather their rows in one task, on the driver or in one Python batch."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirelens.functions import html, skills
from hirelens.operators import alerts, near_names, trigrams
from hirelens.plans.store import JobStore
from hirelens.schemas import OBSERVATION
from hirelens.sources import tables


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def setting(spark):
    """Change settings of the session for one test; None unsets."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_lists_of_near_words_are_short_and_not_broadcast(spark):
    words = [f"Customer#{k:09d}" for k in range(50)]
    names = spark.createDataFrame([(w,) for w in words], "name string")
    tokens = spark.createDataFrame([(w[:9] + w[10:],) for w in words], "token string")
    pairs = near_names.near_pairs(tokens, names)
    assert "BroadcastHashJoin" not in plan_of(pairs) and "SortMergeJoin" in plan_of(pairs)
    # Tokens of 17 letters meet names of 18 by one deletion there: nothing else is listed.
    useful = near_names.useful_lengths([17], [18], 2)
    assert useful == [[17], [], []] and near_names.neighbourhood(tokens, "token", useful).count() == 50
    assert near_names.useful_lengths([18], [17], 2) == [[], [18], []]
    assert near_names.useful_lengths([3], [1, 2, 3, 4, 5, 6], 2) == [[3], [3], [3]]
    assert near_names.nearest_names(tokens, names, 90).filter("ratio > 97").count() == 50


def test_matches_of_one_run_are_not_shuffled_by_run(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(1, str(k), "Python job", False) for k in range(40)] + [(2, "x", "other", False), (None, "y", "Python job", False)]
    jobs = spark.createDataFrame(rows, "run_id long, job_id string, title string, remote boolean").withColumns(
        {c: F.lit(None).cast("string") for c in ("company", "location", "description")} | {"skills": F.array(F.lit("SQL"))})
    stored = alerts.stored_alerts(jobs, ["python"])
    assert "BroadcastHashJoin" in plan_of(stored) and "SortMergeJoin" not in plan_of(stored)
    assert [tuple(r) for r in stored.groupBy("run_id", "total_new", "matching").count().collect()] == [(1, 40, 40, 40)]


def test_scans_are_dealt_to_all_cores(spark, setting, tmp_path):
    setting(tables.SCAN_PARTITIONS, None)
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    cores = spark.sparkContext.defaultParallelism
    dealt = tables.spread_scan(spark.read.parquet(str(tmp_path / "one")))
    assert dealt.rdd.getNumPartitions() == tables.TASKS_A_CORE * cores and dealt.count() == 100
    assert tables.spread_scan(spark.range(100, numPartitions=99)).rdd.getNumPartitions() == 99
    stream = tables.spread_scan(spark.readStream.schema("id long").parquet(str(tmp_path / "one")))
    assert "Repartition" in stream._jdf.queryExecution().analyzed().toString()


def test_elements_of_few_pages_at_a_time(spark, setting, monkeypatch):
    monkeypatch.setattr(html, "SHRED_BYTES", 60)
    pages = ["<p>a</p>", None, "", "<p>" + "é" * 100 + "</p>", "<p>b<i>c</i></p>"] * 20
    frame = spark.createDataFrame(list(enumerate(pages)), "k int, h string").coalesce(1)
    got = frame.select("k", F.transform(html.shred(F.col("h")), lambda e: e["text"]).alias("t")).collect()
    want = [["a"], None, [], ["é" * 100], ["b c", "c"]] * 20
    assert {r.k: r.t for r in got} == dict(enumerate(want))
    monkeypatch.setattr(html, "SHRED_BYTES", 1)
    assert frame.limit(0).select(html.shred(F.col("h"))).collect() == []


def test_postings_come_without_a_shuffle(spark, tmp_path):
    texts = ["abcabc", "xAbC", "ab", None, "😀é😀é", ""]
    rows = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)] + [("0", "abc"), (None, "abcd")], "id string, t string").coalesce(1)
    found = trigrams.postings(rows, "id", F.col("t"))
    assert "Exchange hashpartitioning" not in plan_of(found)
    got = {r.trigram: Counter(r.ids) for r in found.collect()}
    assert got == {"abc": Counter(["0", "1", "0", None]), "bca": Counter("0"), "cab": Counter("0"), "xab": Counter("1"),
                   "bcd": Counter([None]), "😀é😀": Counter("4"), "é😀é": Counter("4")}
    assert all(r.texts == len(r.ids) for r in found.collect())


def test_a_bucket_of_a_base_is_written_by_several_tasks(spark, setting, tmp_path):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(200).select(*[
        (F.concat(F.lit("j"), "id") if f.name == "job_id" else F.col("id") if f.name == "ordinal" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in OBSERVATION.fields])
    store = JobStore(spark, str(tmp_path))
    store.save_records(rows, 1)
    base = store.fold()
    assert base.buckets == 1 and len(list(tmp_path.glob("bases/seq=*/bucket=0/*.parquet"))) > 1
    assert store.jobs().select("job_id").distinct().count() == store.jobs().count() == 200


def test_edit_distances_are_bounded(spark):
    taxonomy = {"Kubernetes": [], "Terraform": [], "PostgreSQL": ["Postgres"]}
    words = spark.createDataFrame([(w,) for w in ("kubernetess", "kuberentes", "terrafrm", "xyzxyzxyzx", "postgress", None)], "w string")
    best = words.select("w", skills.best_choice(F.col("w"), taxonomy, 90).alias("b"))
    assert "levenshtein(w#" in plan_of(best) and "Some(2)" in plan_of(best)
    assert {r.w: r.b and (r.b.name, round(r.b.ratio, 2)) for r in best.collect()} == {
        "kubernetess": ("kubernetes", 95.24), "kuberentes": ("kubernetes", 90.0), "terrafrm": ("terraform", 94.12),
        "xyzxyzxyzx": None, "postgress": ("postgres", 94.12), None: None}


def test_alerts_tag_each_posting_once(spark):
    """The keyword filter stays above the tagging instead of repeating it below."""
    from hirelens.operators import alerts, clean, enrich

    rows = [(k, "src", f"  Senior Data Engineer {k}", "Acme", None, None, None, "We use Python, Spark and SQL") for k in range(3)]
    raw = spark.createDataFrame(
        rows, "ordinal long, source string, title string, company string, location string, posted string, url string, description string")
    tagged = enrich.enrich(clean.clean(raw, F.lit("2026-01-01").cast("timestamp")), fuzzy=False)
    found = alerts.alert_matches(tagged, ["python", "rust", "sql"])
    counts = [df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") for df in (tagged, found)]
    assert counts[0] == counts[1]
    assert found.columns == tagged.columns and found.count() == 3
    assert alerts.alert_matches(tagged, ["rust"]).count() == 0
