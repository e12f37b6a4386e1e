import random
from collections import Counter
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.operators import alerts, analytics, filters, history
from hirelens.operators.quantiles import exact_quantiles

JOB = (
    "job_id string, source string, title string, company string, location string, remote boolean, seniority string, "
    "salary_min double, salary_max double, salary_currency string, skills array<string>, posted_date date, url string, "
    "description string, first_seen timestamp, last_seen timestamp, run_id long, ordinal long"
)


def jobs(spark, *rows):
    names = [part.split()[0] for part in JOB.split(", ")]
    base = {"source": "s", "title": "t", "remote": False, "skills": [], "run_id": 1}
    full = [tuple({**base, "job_id": str(i), "ordinal": i, **r}.get(n) for n in names) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, JOB)


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    rows = []
    for group, size in (("hot", 6000), ("small", 7), ("one", 1), (None, 40), ("ties", 500), ("empty", 0)):
        for _ in range(size):
            value = rng.choice([5.0, 5.0, 6.0]) if group == "ties" else rng.lognormvariate(10, 3)
            rows.append((group, value))
        rows.append((group, None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    assert set(got) == set(want)
    for g, values in want.items():
        assert got[g].n == len(values)
        assert np.allclose(got[g].q, np.quantile(values, probs), rtol=1e-12)
    (whole,) = exact_quantiles(df, "v", [0.5]).collect()
    assert whole.q[0] == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0


def test_weeks_end_on_sunday_and_gaps_count_zero(spark):
    days = [date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 29), None]
    got = analytics.weekly_postings(jobs(spark, *[{"posted_date": d} for d in days])).collect()
    assert [(r.week, r.jobs) for r in got] == [
        (date(2024, 1, 7), 2), (date(2024, 1, 14), 1), (date(2024, 1, 21), 0), (date(2024, 1, 28), 0), (date(2024, 2, 4), 1),
    ]
    assert analytics.weekly_postings(jobs(spark, {})).count() == 0


def test_kpis(spark):
    table = filters.prepare_jobs(jobs(
        spark,
        {"remote": True, "salary_min": 100000.0, "salary_max": 140000.0, "first_seen": datetime(2026, 1, 2, 0, 0), "last_seen": datetime(2026, 1, 2, 9, 5)},
        {"salary_min": 90000.0, "salary_max": 100000.0, "first_seen": datetime(2026, 1, 1, 23), "last_seen": datetime(2026, 1, 1, 23)},
        {"first_seen": datetime(2026, 1, 2, 5), "last_seen": datetime(2026, 1, 2, 5)},
    ))
    got = analytics.kpis(table, F.lit("2026-01-02 18:00:00").cast("timestamp")).first()
    assert (got.total_jobs, got.new_today, got.remote_text, got.median_salary, got.median_text) == (3, 2, "33%", 107500.0, "$108k")
    assert got.update_text == "02 Jan 2026, 09:05 UTC"
    none = analytics.kpis(table.limit(0), F.current_timestamp()).first()
    assert (none.total_jobs, none.remote_text, none.median_text, none.update_text) == (0, "—", "—", "—")


def test_cooccurrence_equals_brute_force(spark):
    rng = random.Random(3)
    names = [f"s{i:02d}" for i in range(20)]
    per_job = {str(j): {n for n in names if rng.random() < 0.25} for j in range(200)}
    rows = [(j, s) for j, chosen in per_job.items() for s in chosen]
    table = spark.createDataFrame(rows, "job_id string, skill string")
    counts = Counter(s for _, s in rows)
    top = sorted(counts, key=lambda s: (-counts[s], s))[:12]
    got = analytics.skill_cooccurrence(table).collect()
    assert len(got) == 144
    for r in got:
        together = sum(r.skill_a in c and r.skill_b in c for c in per_job.values())
        assert r.skill_a in top and r.jobs == (None if r.skill_a == r.skill_b else together)
    matrix = analytics.cooccurrence_matrix(analytics.skill_cooccurrence(table)).collect()
    assert [r.skill for r in matrix] == sorted(top) and matrix[0].with_01 is None


def test_box_and_histogram(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 100.0]
    paid = spark.createDataFrame([("x", v) for v in values], "seniority string, salary_mid double")
    box = analytics.salary_box(paid).first()
    assert (box.q1, box.median, box.q3) == (11.25, 12.5, 13.75)
    assert (box.low_whisker, box.high_whisker, box.outliers, box.jobs) == (10.0, 14.0, 1, 6)
    bins = analytics.salary_histogram(paid, 3).collect()
    assert [(b.bin, b.jobs) for b in bins] == [(1, 5), (3, 1)] and bins[-1].to_salary == 100.0
    same = analytics.salary_histogram(paid.filter("salary_mid = 10")).collect()
    assert [(b.bin, b.jobs) for b in same] == [(1, 1)]


def test_filters(spark):
    table = filters.prepare_jobs(jobs(
        spark,
        {"source": "a", "remote": True, "skills": ["SQL"], "posted_date": date(2024, 1, 1), "company": "C+ (x)"},
        {"source": "b", "skills": ["Go", "SQL"], "posted_date": None, "seniority": "Lead"},
        {"source": "a", "skills": [], "posted_date": date(2024, 2, 1)},
    ))

    def ids(**kw):
        return sorted(r.job_id for r in filters.filter_jobs(table, **kw).collect())

    assert ids() == ["0", "1", "2"]
    assert ids(sources=["a"]) == ["0", "2"] and ids(seniorities=["Not specified"]) == ["0", "2"]
    assert ids(work_mode="remote") == ["0"] and ids(work_mode="onsite") == ["1", "2"]
    assert ids(any_skills=["Go", "Rust"]) == ["1"]
    assert ids(query=" c+ (X) ") == ["0"] and ids(query="go, sql") == ["1"] and ids(query="unspecified") == ["0", "1", "2"]
    assert ids(posted_between=("2024-01-15", "2024-03-01")) == ["1", "2"]


def test_keywords(spark):
    table = jobs(spark, {"title": "Storage Admin"}, {"description": "uses LLMs"}, {"remote": True}, {"skills": ["Go"]}, {})
    def ids(words):
        return sorted(r.job_id for r in alerts.alert_matches(table, words).collect())
    assert ids(["rag"]) == ["0"] and ids(["llm", "REMOTE"]) == ["1", "2"] and ids(["go"]) == ["3"]
    assert len(ids([])) == 5


def test_digest_limits_and_gate(spark):
    rows = [{"title": f"job {i}", "remote": True, "location": "Oslo", "skills": [str(k) for k in range(12)]} for i in range(30)]
    table = jobs(spark, *rows, {"run_id": 2}, {"run_id": 3, "remote": True, "company": "Beta", "salary_min": 9e4, "salary_max": 9e4, "salary_currency": "EUR"})
    got = alerts.digest_rows(table, ["remote"]).orderBy("run_id", "position").collect()
    assert len(got) == 26
    assert [r.title for r in got[:25]] == [f"job {i}" for i in range(25)]
    assert (got[0].total_new, got[0].matching, got[0].more, len(got[0].skills)) == (30, 30, 5, 8)
    assert got[0].meta == "Oslo · Remote" and got[0].brief == "Remote"
    assert got[25].meta == "Beta · Remote · EUR 90k"
    messages = {r.run_id: r.message for r in alerts.alert_messages(table, ["remote"]).collect()}
    assert set(messages) == {1, 3}
    assert messages[1].count("\n") == 10 and messages[3] == "1 new job(s), 1 match your keywords\n• t - Beta · Remote · EUR 90k"
    assert alerts.alert_gate(table, ["remote"], min_new=2).count() == 1
    assert alerts.alert_gate(table, ["remote"], enabled=False).count() == 0


def test_snapshots_are_cumulative_and_runs_without_news_keep_counts(spark):
    table = jobs(
        spark,
        {"run_id": 1, "remote": True, "salary_min": 100.0, "salary_max": 200.0}, {"run_id": 1},
        {"run_id": 3, "salary_min": 10.0, "salary_max": None}, {"run_id": 4, "salary_min": 40.0, "salary_max": 60.0},
    )
    skills = spark.createDataFrame([("0", "Go"), ("1", "Go"), ("2", "SQL"), ("3", "Go")], "job_id string, skill string")
    runs = spark.createDataFrame([(i, date(2024, 1, i)) for i in (1, 2, 3, 4, 5)], "run_id long, snapshot_date date")
    got = {(r.run_id, r.skill): r.job_count for r in history.skill_snapshots(table, skills, runs).collect()}
    assert got == {
        (1, "Go"): 2, (2, "Go"): 2, (3, "Go"): 2, (4, "Go"): 3, (5, "Go"): 3, (3, "SQL"): 1, (4, "SQL"): 1, (5, "SQL"): 1,
    }
    market = {r.run_id: (r.total_jobs, r.remote_jobs, r.avg_salary) for r in history.market_snapshots(table, runs).collect()}
    assert market == {1: (2, 1, 150.0), 2: (2, 1, 150.0), 3: (3, 1, 150.0), 4: (4, 1, 100.0), 5: (4, 1, 100.0)}
    trend = analytics.skill_trend(history.skill_snapshots(table, skills, runs), history.market_snapshots(table, runs))
    assert [(r.skill, r.share) for r in analytics.latest_top(trend, 1).collect()] == [("Go", 75.0)]


def test_run_status(spark):
    rows = spark.createDataFrame([(False, 0, False), (True, 3, False), (True, 0, False), (False, 5, True)], "e boolean, n long, c boolean")
    got = rows.select(history.run_status(F.col("e"), F.col("n"), F.col("c")), history.run_outcome(F.col("e"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("success", "ok"), ("partial", "ok"), ("failed", "failed"), ("failed", "ok")]
