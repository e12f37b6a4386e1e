"""Market questions over prepared jobs. Every one returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.formats import format_money, format_update, salary_text
from hirelens.operators.quantiles import exact_quantiles
from hirelens.operators.salting import join_per_key, salt


def explode_skills(jobs: DataFrame, *columns: str) -> DataFrame:
    """One row per (job, skill); jobs without skills drop out."""
    return jobs.select("job_id", *columns, F.explode("skills").alias("skill"))


def top_values(df: DataFrame, column: str, k: int, name: str = "jobs") -> DataFrame:
    """The k most frequent values; ties in alphabetical order."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), column).limit(k)


def value_counts(df: DataFrame, column: str, name: str = "jobs") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def work_mode(jobs: DataFrame) -> DataFrame:
    label = F.when(F.col("remote"), F.lit(V.REMOTE_LABEL)).otherwise(F.lit(V.ONSITE_LABEL))
    return value_counts(jobs.select(label.alias("mode")), "mode")


def week_ending(day: Column) -> Column:
    """The Sunday that closes the week of ``day``."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def weekly_postings(jobs: DataFrame) -> DataFrame:
    """Postings per week ending on Sunday; weeks without postings count zero."""
    weeks = (
        jobs.filter("posted_date is not null")
        .groupBy(week_ending(F.col("posted_date")).alias("week"))
        .agg(F.count("job_id").alias("jobs"))
    )
    # The calendar is one row of two dates unrolled, a few thousand weeks at most.
    calendar = weeks.agg(F.min("week").alias("a"), F.max("week").alias("b")).filter("a is not null").select(
        F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week")
    )
    return calendar.join(weeks, "week", "left").select(
        "week", F.coalesce("jobs", F.lit(0)).alias("jobs")
    ).orderBy("week")


def kpis(jobs: DataFrame, as_of: Column, runs: DataFrame | None = None) -> DataFrame:
    """One row: totals, new on the day of ``as_of``, remote share, median salary, last update.

    ``as_of`` may be a scalar subquery. The last update is the newest finished run, else the
    newest sighting.
    """
    day = F.date_trunc("day", as_of)
    totals = jobs.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("first_seen") >= day).alias("new_today"),
        (F.avg(F.col("remote").cast("int")) * 100).alias("remote_share"),
        F.max("last_seen").alias("_last_seen"),
    )
    median = exact_quantiles(jobs, "salary_mid", [0.5]).select(F.get("q", F.lit(0)))
    last = F.col("_last_seen")
    if runs is not None:
        last = F.coalesce(runs.agg(F.max("finished_at")).scalar(), last)
    return totals.select(
        "total_jobs",
        "new_today",
        "remote_share",
        median.scalar().alias("median_salary"),
        last.alias("last_update"),
    ).select(
        "*",
        F.coalesce(F.concat(F.format_number(F.bround("remote_share", 0), 0), F.lit("%")), F.lit("—")).alias("remote_text"),
        format_money(F.col("median_salary")).alias("median_text"),
        format_update(F.col("last_update")).alias("update_text"),
    )


def currencies(jobs: DataFrame) -> DataFrame:
    """Currencies of paid jobs, most frequent first; the first row is the default slice."""
    paid = jobs.filter("salary_mid is not null").select(
        F.coalesce("salary_currency", F.lit(V.UNKNOWN_CURRENCY)).alias("currency")
    )
    return value_counts(paid, "currency")


def main_currency(jobs: DataFrame) -> Column:
    """The most frequent currency of paid jobs, as a scalar subquery."""
    return currencies(jobs).limit(1).select("currency").scalar()


def salary_histogram(paid: DataFrame, bins: int = 30) -> DataFrame:
    """Counts in equal bins between the lowest and the highest midpoint; empty bins omitted."""
    span = paid.agg(F.struct(F.min("salary_mid").alias("lo"), F.max("salary_mid").alias("hi")).alias("s")).scalar()
    at = (
        paid.select("salary_mid", span.alias("s"))
        .select("salary_mid", F.col("s")["lo"].alias("lo"), F.col("s")["hi"].alias("hi"))
    )
    number = F.when(F.col("lo") == F.col("hi"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("salary_mid") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins))
    )
    binned = at.groupBy(number.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("jobs"))
    width = (F.col("hi") - F.col("lo")) / bins
    return binned.select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("from_salary"),
        (F.col("lo") + F.col("bin") * width).alias("to_salary"),
        "jobs",
    ).orderBy("bin")


def salary_box(paid: DataFrame, group: str = "seniority") -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 box lengths) and outlier count per group."""
    quartiles = exact_quantiles(paid, "salary_mid", [0.25, 0.5, 0.75], [group]).select(
        group,
        F.get("q", F.lit(0)).alias("q1"),
        F.get("q", F.lit(1)).alias("median"),
        F.get("q", F.lit(2)).alias("q3"),
    )
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("salary_mid").between(F.col("q1") - fence, F.col("q3") + fence)
    counted = paid.groupBy(group, "salary_mid", salt("salary_mid").alias("_salt")).agg(F.count(F.lit(1)).alias("n"))
    return (
        join_per_key(counted, quartiles, [group])
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("salary_mid"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("salary_mid"))).alias("high_whisker"),
            F.sum(F.when(~inside, F.col("n")).otherwise(F.lit(0))).alias("outliers"),
            F.sum("n").alias("jobs"),
        )
        .orderBy(group)
    )


def salary_by_skill(paid_skills: DataFrame, min_jobs: int = 5, k: int = 15) -> DataFrame:
    """Best-paid skills: exact median midpoint among skills with enough paid postings.

    ``paid_skills`` is (skill, salary_mid), one row per posting and skill.
    """
    medians = exact_quantiles(paid_skills, "salary_mid", [0.5], ["skill"])
    return (
        medians.filter(F.col("n") >= min_jobs)
        .select("skill", F.get("q", F.lit(0)).alias("median_salary"), F.col("n").alias("jobs"))
        .orderBy(F.desc("median_salary"), "skill")
        .limit(k)
    )


def skill_cooccurrence(job_skills: DataFrame, k: int = 12) -> DataFrame:
    """(skill_a, skill_b, jobs) for the k most common skills; null on the diagonal, 0 if never.

    One shuffle brings the skills of a job together; the most common skills and their pairs both come
    from it, so the base is read once. Pairs are made of the k skills only: at most k squared a job.
    """
    per_job = job_skills.groupBy("job_id").agg(F.collect_set("skill").alias("s"))
    top = top_values(per_job.select(F.explode("s").alias("skill")), "skill", k).select("skill")
    # k names by construction, whatever the data.
    common = top.agg(F.collect_list("skill")).scalar()
    shared = per_job.select("s", common.alias("common")).select(F.array_intersect("s", "common").alias("s"))
    pairs = (
        shared.filter(F.size("s") > 1)
        .select(F.explode("s").alias("skill_a"), "s")
        .select("skill_a", F.explode("s").alias("skill_b"))
        .filter("skill_a <> skill_b")
        .groupBy("skill_a", "skill_b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = top.agg(F.collect_list("skill").alias("s"))
    grid = names.select(F.explode("s").alias("skill_a"), "s").select("skill_a", F.explode("s").alias("skill_b"))
    jobs = F.when(F.col("skill_a") != F.col("skill_b"), F.coalesce("n", F.lit(0)))
    return grid.join(pairs, ["skill_a", "skill_b"], "left").select(
        "skill_a", "skill_b", jobs.alias("jobs")
    ).orderBy("skill_a", "skill_b")


def cooccurrence_matrix(pairs: DataFrame, k: int = 12) -> DataFrame:
    """The same as a matrix: one row per skill, one column per alphabetical position."""
    columns = [f"with_{i:02d}" for i in range(1, k + 1)]
    row = pairs.groupBy("skill_a").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("skill_b", "jobs"))), lambda p: p["jobs"]).alias("r")
    )
    return row.select(
        F.col("skill_a").alias("skill"), *[F.get("r", F.lit(i)).alias(c) for i, c in enumerate(columns)]
    ).orderBy("skill")


def explorer(jobs: DataFrame) -> DataFrame:
    """Table view, newest postings first, undated last."""
    shown = jobs.withColumn(
        "salary", salary_text(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"))
    )
    return shown.orderBy(F.desc_nulls_last("posted_date"), "job_id").select(
        "title", "company", "location", "remote", "seniority", "salary",
        F.array_join("skills", ", ").alias("skills"),
        F.col("posted_date").alias("posted"), "source", "url",
    )


def any_from_source(jobs: DataFrame, source: str) -> DataFrame:
    """One row telling whether any job came from the source; null counts as no."""
    return jobs.agg(F.coalesce(F.max(F.col("source") == source), F.lit(False)).alias("present"))


# --- trends over snapshots ------------------------------------------------------------------


def skill_trend(skill_snapshots: DataFrame, market_snapshots: DataFrame) -> DataFrame:
    """Share of all jobs naming each skill, per run.

    The market side has one row per run; no hint is given, Spark checks its size.
    """
    market = market_snapshots.select("run_id", "total_jobs")
    return skill_snapshots.join(market, "run_id").withColumn(
        "share", F.try_divide(F.col("job_count") * F.lit(100.0), F.col("total_jobs"))
    )


def has_trend(market_snapshots: DataFrame) -> DataFrame:
    """Trends need at least two runs."""
    return market_snapshots.agg(F.countDistinct("run_id").alias("runs")).select(
        "runs", (F.col("runs") >= 2).alias("shown")
    )


def latest_top(trend: DataFrame, k: int = 6) -> DataFrame:
    """Skills with the largest share in the newest run."""
    newest = trend.agg(F.max("run_id")).scalar()
    return trend.filter(F.col("run_id") == newest).orderBy(F.desc("share"), "skill").limit(k)


def trend_of(trend: DataFrame, skills: list[str] | None = None, k: int = 6) -> DataFrame:
    """Trend lines of the given skills, else of the k leading ones of the newest run.

    Leaders need three looks at the trend: pass a stored one, not one that is computed at each look.
    """
    if skills is not None:
        return trend.filter(F.col("skill").isin(*skills))
    return trend.join(F.broadcast(latest_top(trend, k).select("skill")), "skill", "left_semi")
