"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs (default 3).

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS] and prints one JSON
line. Results go to the noop writer, so every row is computed and none is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hirelens.plans.queries import QUERIES  # noqa: E402
from hirelens.session import local_session  # noqa: E402

HEADLINE = [
    "top_skills", "top_companies", "weekly_postings", "kpis", "salary_hist", "salary_box", "salary_by_skill",
    "skill_cooccurrence", "filter_jobs", "search_jobs", "explorer", "jobs_upsert", "new_jobs_per_run",
    "skill_snapshots", "market_snapshots", "skill_trend", "normalize_text", "parse_dates", "clean_dedup",
    "dq_violations", "salary_extract", "skill_tags", "enriched", "entity_fill", "page_cards", "url_allowed",
    "comment_postings", "alert_digest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
