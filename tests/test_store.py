import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from hirelens.operators import history
from hirelens.plans.batch import READERS, run_once
from hirelens.plans.store import JobStore, append_csv
from hirelens.schemas import OBSERVATION
from hirelens.session import TASK_BYTES
from hirelens import fixed_values as V

CARD = """<div class="card-content"><h2 class="title">{title}</h2><h3 class="company">Beta</h3>
<p class="location">oslo, norway</p><time datetime="2026-01-0{day}"></time>
<footer><a class="card-footer-item" href="/apply/{day}">Apply</a></footer></div>"""


def records(spark, run, *ids, **fields):
    base = {
        "source": "s", "title": "t", "remote": True, "salary_min": 100000.0, "salary_max": 140000.0,
        "salary_currency": "USD", "skills": ["Python", "SQL"], "scraped_at": datetime(2026, 1, run),
    }
    rows = [
        tuple({**base, **fields, "job_id": j, "ordinal": i, "run_id": run}.get(f.name) for f in OBSERVATION.fields)
        for i, j in enumerate(ids)
    ]
    return spark.createDataFrame(rows, OBSERVATION)


def test_new_known_and_repeated_runs(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    assert store.jobs().count() == 0
    first = store.save_records(records(spark, 1, "a", "b"), 1)
    assert sorted(r.job_id for r in first.collect()) == ["a", "b"]
    for _ in range(2):
        again = store.save_records(records(spark, 2, "a", "c", title="changed"), 2)
        assert [r.job_id for r in again.collect()] == ["c"]
    rows = {r.job_id: r for r in store.jobs().collect()}
    assert len(rows) == 3 and rows["a"].title == "t"
    assert rows["a"].first_seen == datetime(2026, 1, 1) and rows["a"].last_seen == datetime(2026, 1, 2)
    assert rows["b"].last_seen == datetime(2026, 1, 1)
    assert store.job_skills().count() == 6


def test_snapshots_continue_from_the_run_before(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, "a"), 1)
    store.snapshot(1, date(2026, 1, 1))
    store.save_records(records(spark, 2, "a", "b", remote=False, skills=["Python"], salary_max=None), 2)
    for _ in range(2):
        store.snapshot(2, date(2026, 1, 2))
    counts = {(r.run_id, r.skill): r.job_count for r in store.skill_snapshots().collect()}
    assert counts == {(1, "Python"): 1, (1, "SQL"): 1, (2, "Python"): 2, (2, "SQL"): 1}
    market = {r.run_id: (r.total_jobs, r.remote_jobs, r.avg_salary, r.snapshot_date) for r in store.market_snapshots().collect()}
    assert market == {1: (1, 1, 120000.0, date(2026, 1, 1)), 2: (2, 1, 120000.0, date(2026, 1, 2))}
    whole = history.skill_snapshots(
        store.first_records(), store.job_skills(), spark.createDataFrame([(1, date(2026, 1, 1)), (2, date(2026, 1, 2))], "run_id long, snapshot_date date")
    )
    assert {(r.run_id, r.skill): r.job_count for r in whole.collect()} == counts


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    append_csv(records(spark, 1, "a", title='say "hi", you'), path)
    append_csv(records(spark, 2, "b", skills=[], salary_min=None), path)
    rows = {r.job_id: r for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()}
    assert list(rows["a"].asDict()) == V.CSV_COLUMNS
    assert rows["a"].skills == "Python; SQL" and rows["a"].title == 'say "hi", you'
    assert rows["a"].scraped_at == "2026-01-01T00:00:00+00:00" and rows["a"].remote == "True" and rows["b"].salary_min is None and rows["b"].skills is None


def test_upsert_step(spark):
    before = history.fold_jobs(records(spark, 1, "a", "b"), ["title"])
    after = history.upsert(before, records(spark, 2, "b", "c", title="new"))
    got = {r.job_id: (r.title, r.first_seen.day, r.last_seen.day) for r in after.collect()}
    assert got == {"a": ("t", 1, 1), "b": ("t", 1, 2), "c": ("new", 2, 2)}


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.html").write_text(
        "<html>" + CARD.format(title="Senior Python Dev", day=1) + CARD.format(title="Data Analyst", day=2) + "</html>"
    )
    (tmp_path / "threads.json").write_text(json.dumps({"hits": [{"objectID": "99", "title": "Ask HN: Who is hiring? (May)"}]}))
    (tmp_path / "comments.json").write_text(json.dumps({"nbPages": 1, "hits": [
        {"objectID": "1", "parent_id": 99, "created_at": "2026-01-02T09:00:00Z",
         "comment_text": "Beta | Senior AI Engineer | Remote | $150k-$180k<p>Python, LangChain &amp; AWS."},
        {"objectID": "2", "parent_id": 1, "comment_text": "Reply | Engineer | No"},
    ]}))
    return {
        "fake_jobs": {"pages": str(tmp_path / "pages"), "base_url": "https://jobs.test/list/"},
        "hn_hiring": {"comments": str(tmp_path / "comments.json"), "threads": str(tmp_path / "threads.json")},
    }


def test_whole_run_twice(spark, tmp_path, landed):
    root = str(tmp_path / "store")
    when = datetime(2026, 1, 5, tzinfo=timezone.utc)
    first = run_once(spark, root, list(READERS), landed, started=when, csv_path=str(tmp_path / "csv"))
    assert (first.fetched, first.unique, first.valid, first.invalid, first.new, first.status) == (3, 3, 3, 0, 3, "success")
    again = run_once(spark, root, list(READERS), landed, csv_path=str(tmp_path / "csv"))
    assert (again.run_id, again.fetched, again.new) == (2, 3, 0)
    store = JobStore(spark, root)
    job = store.jobs().filter("source = 'hn_hiring'").first()
    assert job.remote and job.seniority == "Senior" and job.salary_max == 180000.0
    assert job.skills == ["Python", "AWS", "LangChain"] and job.posted_date == date(2026, 1, 2)
    listed = store.jobs().filter("title = 'Data Analyst'").first()
    assert listed.url == "https://jobs.test/apply/2" and listed.location == "Oslo, Norway"
    assert [r.status for r in store.runs().collect()] == ["success", "success"]
    alerts = spark.read.parquet(f"{root}/alerts/run_id=1")
    assert alerts.count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_failing_source_does_not_stop_the_others(spark, tmp_path, landed):
    def broken(spark, options):
        return spark.range(3).select(F.raise_error(F.lit("feed is down")).alias("title"), F.col("id").alias("ordinal"))

    readers = {**READERS, "broken": broken}
    landed["hn_hiring"]["comments"] = str(tmp_path / "missing.json")
    stats = run_once(spark, str(tmp_path / "store"), ["broken", "nope", *READERS], landed, readers=readers)
    assert stats.status == "partial" and stats.fetched == 2
    assert [e.split(":")[0] for e in stats.errors] == ["broken", "nope", "hn_hiring"]
    assert stats.errors[1] == "nope: unknown source"
    run = JobStore(spark, str(tmp_path / "store")).runs().first()
    assert run.status == "partial" and "; " in run.errors


def test_only_failures(spark, tmp_path):
    stats = run_once(spark, str(tmp_path / "store"), ["nope"], {})
    assert stats.status == "failed" and stats.fetched == 0 and stats.new == 0


def test_a_run_without_snapshot_is_counted_later(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, "a"), 1)
    store.snapshot(1, date(2026, 1, 1))
    store.save_records(records(spark, 2, "b", "c"), 2)
    store.save_records(records(spark, 3, "d"), 3)
    store.snapshot(3, date(2026, 1, 3))
    totals = {r.run_id: r.total_jobs for r in store.market_snapshots().collect()}
    assert totals == {1: 1, 3: 4}
    store.save_records(records(spark, 1, "a", "e"), 1)
    store.snapshot(1, date(2026, 1, 1))
    totals = {r.run_id: r.total_jobs for r in store.market_snapshots().collect()}
    assert totals == {1: 2, 3: 5}
    assert {r.job_count for r in store.skill_snapshots().filter("run_id = 3").collect()} == {5}


def test_all_alerts_are_stored_and_the_digest_is_a_view(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, *[f"j{k}" for k in range(60)], title="python"), 1)
    assert store.save_alerts(1, ["python"]).count() == 60
    digest = store.alert_digest().collect()
    assert len(digest) == V.DIGEST_ITEMS and {(r.total_new, r.matching, r.more) for r in digest} == {(60, 60, 60 - V.DIGEST_ITEMS)}
    assert store.save_alerts(1, ["python"], enabled=False).count() == 0


def test_repeats_inside_a_batch_are_one_job(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    assert store.save_records(records(spark, 1, "a", "b", "a"), 1).count() == 2


def test_batches_are_tagged_in_small_tasks(spark, tmp_path, monkeypatch):
    seen, write = [], JobStore._write
    monkeypatch.setattr(JobStore, "_write", lambda self, df, table, run_id: (
        seen.append((table, self.spark.conf.get(TASK_BYTES, None))), write(self, df, table, run_id)))
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, "a", "b"), 1)
    assert seen == [("observations", "4MB"), ("jobs", None)] and spark.conf.get(TASK_BYTES, None) is None
    # A size that the job sets stays.
    spark.conf.set(TASK_BYTES, "32MB")
    try:
        store.save_records(records(spark, 2, "c"), 2)
        assert seen[2:] == [("observations", "32MB"), ("jobs", "32MB")] and spark.conf.get(TASK_BYTES) == "32MB"
    finally:
        spark.conf.unset(TASK_BYTES)


def test_run_ids_are_claimed_once(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    assert [store._claim(1) for _ in range(3)] == [1, 2, 3]
    assert store.start_run(datetime(2026, 1, 1)) == 4


def table_of(store):
    return {r.job_id: (r.run_id, r.title, r.first_seen.day, r.last_seen.day) for r in store.jobs().collect()}


def damage(root, *runs):
    """Make the files of some runs unreadable."""
    for run in runs:
        for file in [f for t in ("observations", "jobs") for f in (root / t / f"run_id={run}").glob("*.parquet")]:
            (file.parent / f".{file.name}.crc").unlink()
            file.write_bytes(b"damaged")


def test_base_and_runs_since(spark, tmp_path):
    plain, store = JobStore(spark, str(tmp_path / "plain")), JobStore(spark, str(tmp_path / "based"))
    batches = [("a", "b"), ("b", "c"), ("a", "d"), ("c", "e"), ("f",)]
    for run, ids in enumerate(batches, 1):
        rows = records(spark, run, *ids, title=f"t{run}")
        plain.save_records(rows, run)
        new = store.save_records(rows, run)
        assert sorted(r.job_id for r in new.collect()) == sorted(set(ids) - set("".join(map("".join, batches[:run - 1]))))
        if run == 3:
            base = store.fold()
            assert (base.version, base.rows) == (3, 4)
    assert table_of(store) == table_of(plain) == {
        "a": (1, "t1", 1, 3), "b": (1, "t1", 1, 2), "c": (2, "t2", 2, 4), "d": (3, "t3", 3, 3), "e": (4, "t4", 4, 4), "f": (5, "t5", 5, 5)}
    assert set(store.jobs().columns) == set(plain.jobs().columns)
    # Runs that the base covers are read no more, neither by the table nor by the next run or base.
    damage(tmp_path / "based", 1, 2, 3)
    assert table_of(store) == table_of(plain)
    assert store.save_records(records(spark, 6, "a", "g"), 6).count() == 1
    assert store.fold().rows == 7
    damage(tmp_path / "based", 4, 5, 6)
    assert {j: r[3] for j, r in table_of(store).items()} == {"a": 6, "b": 2, "c": 4, "d": 3, "e": 4, "f": 5, "g": 6}


def test_a_repeated_run_voids_the_bases_that_cover_it(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    for run, ids in ((1, "ab"), (2, "bc"), (3, "cd")):
        store.save_records(records(spark, run, *ids), run)
        if run < 3:
            store.fold()
    assert store.base().version == 2
    store.save_records(records(spark, 2, "b", "x", title="again"), 2)
    assert store.base().version == 1
    assert {j: r[0] for j, r in table_of(store).items()} == {"a": 1, "b": 1, "x": 2, "d": 3}
    assert store.fold().version == 3 and {j: r[0] for j, r in table_of(store).items()} == {"a": 1, "b": 1, "x": 2, "d": 3}


def test_a_run_that_ends_during_a_fold_voids_it(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, "a"), 1)
    number = store._next_number()
    store.save_records(records(spark, 2, "b"), 2)
    store._log_base(number, 2, None, 1, 1, 1)
    assert store.base() is None and set(table_of(store)) == {"a", "b"}


def test_bases_of_an_empty_store(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    assert store.fold() is None and store.base() is None and store.fold_if_due() is None


def test_a_base_is_due_by_rows(spark, tmp_path, monkeypatch):
    from hirelens.plans import store as module
    monkeypatch.setattr(module, "FOLD_ROWS", 3)
    store = JobStore(spark, str(tmp_path))
    for fetched in (2, 2, 1, 2):
        run = store.start_run(datetime(2026, 1, 1))
        store.save_records(records(spark, run, *[f"{run}-{k}" for k in range(fetched)]), run)
        store.finish_run(run, datetime(2026, 1, 1), "success", fetched, fetched, 0)
        base = store.fold_if_due()
    assert (base.version, base.rows) == (4, 7)


def test_claims_pass_over_runs_stored_without_one(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    store.save_records(records(spark, 1, "a"), 1)
    assert store.start_run(datetime(2026, 1, 1)) == 2


def test_counters_of_sources(spark, tmp_path, landed):
    from hirelens.sources.comments import parse_rate

    stats = run_once(spark, str(tmp_path / "store"), list(READERS), landed)
    # One top-level comment, which is a posting; the reply is not read as one.
    assert stats.sources == {"hn_hiring": {"comments": 1, "parsed": 1}}
    assert parse_rate(stats.sources["hn_hiring"]) == 1.0 and parse_rate({"comments": 0, "parsed": 0}) is None


def test_ordinals_beyond_their_room_are_an_error(spark, tmp_path, landed):
    from hirelens.plans.batch import collect

    def far(spark, options):
        return spark.createDataFrame([(10**16, *["x"] * 7)], "ordinal long, source string, title string, company string, "
                                     "location string, posted string, url string, description string")

    rows, errors = collect(spark, ["far", "fake_jobs"], landed, str(tmp_path / "landing"), {**READERS, "far": far})
    assert [e.split(":")[0] for e in errors] == ["far"] and rows.count() == 2
