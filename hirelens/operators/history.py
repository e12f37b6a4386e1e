"""Incremental tables as folds over observations: upsert, run log, cumulative snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def fold_jobs(observations: DataFrame, attributes: Sequence[str], seen: str = "scraped_at") -> DataFrame:
    """Job table after all runs: attributes as first seen, ``first_seen``, ``last_seen``.

    A later sighting changes nothing but ``last_seen``. Both picks aggregate map-side, so a
    job sighted very often is no hot key.
    """
    place = F.struct("run_id", "ordinal")
    folded = observations.groupBy("job_id").agg(
        F.min_by(F.struct(*attributes, F.col("run_id"), F.col(seen).alias("first_seen")), place).alias("a"),
        F.max_by(seen, place).alias("last_seen"),
    )
    return folded.select("job_id", "a.*", "last_seen")


def upsert(jobs: DataFrame, batch: DataFrame, seen: str = "scraped_at") -> DataFrame:
    """Job table after one batch (one row per job_id): unseen jobs are added, known ones only
    get a new ``last_seen``."""
    sightings = batch.select("job_id", F.col(seen).alias("_seen"))
    refreshed = jobs.join(sightings, "job_id", "left").withColumn(
        "last_seen", F.coalesce("_seen", "last_seen")
    ).select(*jobs.columns)
    fresh = new_records(batch, jobs).withColumns({"first_seen": F.col(seen), "last_seen": F.col(seen)})
    return refreshed.unionByName(fresh.select(*jobs.columns))


def new_records(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the batch whose job_id is not known.

    Known ids are first cut to those of the batch: a batch below Spark's broadcast size then
    spares the (much larger) job table its shuffle.
    """
    met = known.select("job_id").join(batch.select("job_id"), "job_id", "left_semi")
    return batch.join(met, "job_id", "left_anti")


def known_records(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the batch that only refresh a known job."""
    met = known.select("job_id").join(batch.select("job_id"), "job_id", "left_semi")
    return batch.join(met, "job_id", "left_semi")


def sightings_per_run(observations: DataFrame) -> DataFrame:
    """(run_id, records, new, known) of every run, in one pass over narrow rows."""
    per_run = observations.groupBy("job_id", "run_id").agg(F.count(F.lit(1)).alias("n"))
    # Rows per job: the runs it was seen in.
    first = F.min("run_id").over(Window.partitionBy("job_id"))
    return (
        per_run.withColumn("is_new", F.col("run_id") == first)
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if("is_new").alias("new"),
            F.count_if(~F.col("is_new")).alias("known"),
        )
    )


# --- snapshots -----------------------------------------------------------------------------


# Runs of one block of the running sums: no row and no window group holds more runs, or a step for each block.
BLOCK_RUNS = 64


def _block(run_id: Column) -> Column:
    return F.floor(run_id / BLOCK_RUNS).cast("long")


def skill_snapshots(jobs: DataFrame, job_skills: DataFrame, runs: DataFrame) -> DataFrame:
    """Skill counts as of every run, all runs in one job.

    A run counts each job first seen at or before it; a skill appears once its count is at
    least one. ``jobs`` is (job_id, run_id), ``runs`` (run_id, snapshot_date).

    Running sums in blocks of run ids: totals per (skill, block) give what a skill has before each of
    its blocks, and the steps inside a block are spread over the runs of that block only.
    """
    placed = job_skills.select("job_id", "skill").join(jobs.select("job_id", "run_id"), "job_id")
    gained = placed.groupBy("skill", "run_id").agg(F.count(F.lit(1)).alias("n"))
    steps = gained.groupBy("skill", _block(F.col("run_id")).alias("block")).agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("run_id", "n"))).alias("steps"))
    calendar = runs.select("run_id", "snapshot_date").distinct()
    blocks = calendar.groupBy(_block(F.col("run_id")).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("run_id", "snapshot_date"))).alias("runs"))
    last = blocks.agg(F.max("block")).scalar()
    # A skill has a row for each block from its first on: one for up to 64 rows of the result.
    by_skill = Window.partitionBy("skill").orderBy("block")
    held = steps.select("skill", "block", "total", "steps", F.lead("block").over(by_skill).alias("next")).select(
        "skill", "total", "steps", F.col("block").alias("own"),
        F.explode(F.sequence("block", F.greatest("block", F.coalesce(F.col("next") - 1, last)))).alias("block"))
    is_own = F.col("block") == F.col("own")
    rows = held.select(
        "skill", "block", F.when(is_own, F.col("steps")).alias("steps"),
        (F.sum(F.when(is_own, F.col("total")).otherwise(0)).over(by_skill.rowsBetween(Window.unboundedPreceding, 0))
         - F.when(is_own, F.col("total")).otherwise(0)).alias("before")).join(blocks, "block")

    def up_to(run: Column) -> Column:
        inside = F.filter(F.coalesce("steps", F.array().cast("array<struct<run_id:bigint,n:bigint>>")),
                          lambda s: s["run_id"] <= run["run_id"])
        return F.aggregate(inside, F.col("before"), lambda sum_, s: sum_ + s["n"])

    spread = rows.select("skill", F.inline(F.transform("runs", lambda r: F.struct(
        r["run_id"].alias("run_id"), r["snapshot_date"].alias("snapshot_date"), up_to(r).alias("job_count")))))
    return spread.filter("job_count > 0").select("run_id", "snapshot_date", "skill", "job_count")


def market_totals() -> list[Column]:
    """Totals that add up over runs."""
    mid = (F.col("salary_min") + F.col("salary_max")) / 2
    return [
        F.count(F.lit(1)).alias("total_jobs"),
        F.coalesce(F.sum(F.col("remote").cast("int")), F.lit(0)).cast("long").alias("remote_jobs"),
        F.coalesce(F.sum(mid), F.lit(0.0)).alias("salary_total"),
        F.count(mid).alias("paid_jobs"),
    ]


def market_snapshots(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Market totals as of every run: all jobs, remote jobs, average salary midpoint.

    Sums run inside blocks of run ids; what lies before a block comes from one row per block, which are
    the only rows that share a window.
    """
    per_run = jobs.groupBy("run_id").agg(*market_totals())
    totals = ["total_jobs", "remote_jobs", "salary_total", "paid_jobs"]
    filled = runs.select("run_id", "snapshot_date").distinct().join(per_run, "run_id", "left").select(
        _block(F.col("run_id")).alias("block"), "run_id", "snapshot_date", *[F.coalesce(t, F.lit(0)).alias(t) for t in totals])
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = filled.groupBy("block").agg(*[F.sum(t).alias(t) for t in totals]).select(
        "block", *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_{t}") for t in totals])
    inside = Window.partitionBy("block").orderBy("run_id").rowsBetween(Window.unboundedPreceding, 0)
    grown = filled.join(before, "block").select(
        "run_id", "snapshot_date", *[(F.sum(t).over(inside) + F.col(f"_{t}")).alias(t) for t in totals])
    return with_average(grown)


def with_average(totals: DataFrame) -> DataFrame:
    return totals.select(
        "run_id",
        "snapshot_date",
        "total_jobs",
        "remote_jobs",
        F.try_divide("salary_total", "paid_jobs").alias("avg_salary"),
        "salary_total",
        "paid_jobs",
    )


def market_by_currency(jobs: DataFrame) -> DataFrame:
    """Average midpoint per currency; the market snapshot mixes currencies."""
    mid = (F.col("salary_min") + F.col("salary_max")) / 2
    return jobs.groupBy("salary_currency").agg(F.count(mid).alias("paid_jobs"), F.avg(mid).alias("avg_salary"))


# --- run log ---------------------------------------------------------------------------------


def run_status(has_errors: Column, fetched: Column, crashed: Column | None = None) -> Column:
    status = F.when(~has_errors, F.lit("success")).when(fetched > 0, F.lit("partial")).otherwise(F.lit("failed"))
    return status if crashed is None else F.when(crashed, F.lit("failed")).otherwise(status)


def run_outcome(has_errors: Column, fetched: Column) -> Column:
    """Exit outcome: fine if anything was fetched or nothing went wrong."""
    return F.when((fetched > 0) | ~has_errors, F.lit("ok")).otherwise(F.lit("failed"))


def latest_runs(log: DataFrame) -> DataFrame:
    """Run log as a table: the last row written for each run wins; newest run first."""
    rest = [c for c in log.columns if c not in ("run_id", "seq")]
    last = log.groupBy("run_id").agg(F.max_by(F.struct(*rest), "seq").alias("r"))
    return last.select("run_id", "r.*").orderBy(F.desc("run_id"))


def new_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("run_id", "status").agg(F.sum("records_new").alias("records_new"))
