"""Operators whose intermediate rows are bounded, against plain rules."""

import random
from collections import defaultdict
from datetime import date, timedelta

from pyspark.sql import functions as F

from hirelens.operators import enrich, history
from hirelens.sources.listing import url_allowed


def test_snapshots_over_many_blocks(spark):
    pick = random.Random(1)
    calendar = sorted(pick.sample(range(-70, 700), 150))
    days = {r: date(2024, 1, 1) + timedelta(days=r) for r in calendar}
    jobs = [(str(k), pick.choice(calendar), bool(k % 2), float(k) if k % 3 else None, float(k + 2)) for k in range(400)]
    skills = [(j[0], s) for j in jobs for s in ("a", "b", "c", "d") if pick.random() < {"a": 0.9, "b": 0.2, "c": 0.05, "d": 0.01}[s]]
    frame = spark.createDataFrame(jobs, "job_id string, run_id long, remote boolean, salary_min double, salary_max double")
    runs = spark.createDataFrame(list(days.items()) * 2, "run_id long, snapshot_date date")
    found = history.skill_snapshots(frame, spark.createDataFrame(skills, "job_id string, skill string"), runs).collect()
    run_of = {j[0]: j[1] for j in jobs}
    want = defaultdict(int)
    for job, skill in skills:
        for run in calendar:
            want[run, skill] += run_of[job] <= run
    assert {(r.run_id, r.skill): (r.job_count, r.snapshot_date) for r in found} == {
        k: (n, days[k[0]]) for k, n in want.items() if n} and len(found) == sum(n > 0 for n in want.values())
    market = {r.run_id: (r.total_jobs, r.remote_jobs, r.paid_jobs, r.salary_total) for r in history.market_snapshots(frame, runs).collect()}
    for run in calendar:
        held = [j for j in jobs if j[1] <= run]
        paid = [(j[3] + j[4]) / 2 for j in held if j[3] is not None]
        assert market[run] == (len(held), sum(j[2] for j in held), len(paid), sum(paid))


def test_snapshots_of_nothing(spark):
    jobs = spark.createDataFrame([], "job_id string, run_id long, remote boolean, salary_min double, salary_max double")
    skills = spark.createDataFrame([], "job_id string, skill string")
    runs = spark.createDataFrame([], "run_id long, snapshot_date date")
    assert history.skill_snapshots(jobs, skills, runs).count() == 0 and history.market_snapshots(jobs, runs).count() == 0


def test_first_rule_whose_prefix_fits(spark):
    pick = random.Random(2)
    letters = ["a", "b", "/", "ab", "aab"]
    rules = [(f"h{pick.randrange(3)}", k, "/" + "".join(pick.choices(letters, k=pick.randrange(7))), pick.random() < 0.5) for k in range(400)]
    rules += [("h0", -1, "", False), ("h9", 1, "/", False)]
    pick.shuffle(rules)
    urls = [f"https://H{pick.randrange(4)}" + "/" + "".join(pick.choices(letters, k=pick.randrange(9))) for _ in range(500)]
    urls += ["https://h0", None, "no url", "", "https://h9?x=/", urls[0], urls[0]]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id int, url string, host string")
    got = url_allowed(pages, spark.createDataFrame(rules, "host string, ord int, prefix string, allow boolean"))
    assert got.columns == ["page_id", "url", "host", "allowed"]

    def want(url):
        if not url or "://" not in url:
            return True
        rest = url.split("://")[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:] or "/"
        fits = [r for r in rules if r[0] == host and r[2] and path.startswith(r[2])]
        return min(fits, key=lambda r: r[1])[3] if fits else True

    assert {r.page_id: r.allowed for r in got.collect()} == {k: want(u) for k, u in enumerate(urls)}
    assert url_allowed(pages, spark.createDataFrame([], "host string, ord int, prefix string, allow boolean")).filter("allowed").count() == len(urls)


def test_names_of_several_words(spark):
    names = [("Acme", "ORG"), ("Acme Labs", "ORG"), ("Acme Labs of New York", "ORG"), ("New York", "GPE"), ("York", "GPE"),
             ("a b c d e f g h i j", "ORG"), ("New York", "GPE")]
    texts = ["At York (Acme Labs, New York)", "Acme Labs of New York hires", "Acme Labs of New Jersey", "the a b c d e f g h i j", "", "new york",
             "New  York and Acme", "York Acme Acme Labs"]
    rows = [(str(k), None, t) for k, t in enumerate(texts)]
    records = spark.createDataFrame(rows, "job_id string, title string, description string")
    got = {r.job_id: (r._org, r._gpe) for r in enrich.entity_mentions(records, spark.createDataFrame(names, "name string, kind string")).collect()}
    assert got == {"0": ("Acme Labs", "York"), "1": ("Acme Labs of New York", "New York"), "2": ("Acme Labs", None),
                   "3": ("a b c d e f g h i j", None), "6": ("Acme", "New York"), "7": ("Acme", "York")}
    plan = enrich.entity_mentions(records, spark.createDataFrame(names, "name string, kind string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_words" not in plan.split("Join")[0]
    assert enrich.entity_mentions(records, spark.createDataFrame([], "name string, kind string")).count() == 0
