"""Filters over prepared jobs; every one is a predicate Catalyst can push to the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.salary import salary_mid
from hirelens.functions.text import bind


def prepare_jobs(jobs: DataFrame) -> DataFrame:
    """Defaults for gaps, salary midpoint, skills as an array."""
    defaults = {
        "seniority": F.coalesce("seniority", F.lit(V.DEFAULT_SENIORITY)),
        "company": F.coalesce("company", F.lit(V.DEFAULT_COMPANY)),
        "location": F.coalesce("location", F.lit(V.DEFAULT_LOCATION)),
        "salary_mid": salary_mid(F.col("salary_min"), F.col("salary_max")),
    }
    if "skills" in jobs.columns:
        defaults["skills"] = F.coalesce("skills", F.array().cast("array<string>"))
    return jobs.withColumns(defaults)


def search_text() -> Column:
    return F.lower(
        F.concat_ws(" ", "title", "company", "location", F.array_join("skills", ", "))
    )


def filter_jobs(
    jobs: DataFrame,
    sources: Sequence[str] | None = None,
    seniorities: Sequence[str] | None = None,
    work_mode: str = "all",
    any_skills: Sequence[str] = (),
    query: str = "",
    posted_between: tuple[date | str, date | str] | None = None,
) -> DataFrame:
    """The sidebar filters on prepared jobs; undated jobs pass the date filter."""
    out = jobs
    if sources is not None:
        out = out.filter(F.col("source").isin(*sources))
    if seniorities is not None:
        out = out.filter(F.col("seniority").isin(*seniorities))
    if work_mode == "remote":
        out = out.filter("remote")
    elif work_mode == "onsite":
        out = out.filter(~F.col("remote"))
    if any_skills:
        out = out.filter(F.arrays_overlap("skills", F.array(*[F.lit(s) for s in any_skills])))
    if query.strip():
        out = out.filter(F.contains(search_text(), F.lit(query.strip().lower())))
    if posted_between is not None:
        low, high = (F.lit(str(d)).cast("date") for d in posted_between)
        out = out.filter(F.col("posted_date").between(low, high) | F.col("posted_date").isNull())
    return out


def filter_domains(jobs: DataFrame, job_skills: DataFrame | None = None) -> DataFrame:
    """(domain, option) rows: distinct sources, seniorities, skills and the date range, in order."""
    skills = (
        jobs.select(F.explode("skills").alias("option")) if job_skills is None
        else job_skills.select(F.col("skill").alias("option"))
    )
    # One pass over the jobs; equal options merge map-side.
    fields = jobs.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(name).alias("domain"), F.col(column).cast("string").alias("option"))
                for name, column in (("source", "source"), ("seniority", "seniority"), ("posted", "posted_date"))
            ])
        )
    )
    options = fields.unionByName(skills.select(F.lit("skill").alias("domain"), "option")).filter(
        "option is not null"
    ).distinct()
    # ISO dates sort as text; of the dates only the first and the last remain.
    edges = F.when(
        F.col("domain") == "posted",
        F.array(
            F.struct(F.lit("posted_from").alias("domain"), F.min("option").alias("option")),
            F.struct(F.lit("posted_to").alias("domain"), F.max("option").alias("option")),
        ),
    )
    key = F.when(F.col("domain") != "posted", F.col("option"))
    grouped = options.groupBy("domain", key.alias("key")).agg(edges.alias("edges"))
    rows = F.coalesce("edges", F.array(F.struct("domain", F.col("key").alias("option"))))
    return grouped.select(F.inline(rows)).orderBy("domain", "option")


def currency_slice(jobs: DataFrame, currency: str | Column) -> DataFrame:
    """Paid jobs of one currency; a missing code counts as ``Unknown``.

    ``currency`` may be a scalar subquery, such as the most frequent one.
    """
    paid = jobs.filter(F.col("salary_mid").isNotNull())
    return paid.filter(F.coalesce("salary_currency", F.lit(V.UNKNOWN_CURRENCY)) == currency)


def alert_text(columns: Sequence[str]) -> Column:
    """Lower-case text the alert keywords are looked up in."""
    empty = F.lit("")

    def part(name: str) -> Column:
        return F.coalesce(F.col(name), empty) if name in columns else empty

    return F.lower(
        F.concat_ws(
            " ",
            part("title"),
            part("company"),
            part("location"),
            F.coalesce(F.array_join("skills", " "), empty) if "skills" in columns else empty,
            part("description"),
            F.when(F.col("remote"), F.lit("remote")).otherwise(empty),
        )
    )


def matches_keywords(columns: Sequence[str], keywords: Sequence[str]) -> Column:
    """True if any keyword is a substring; no keywords match everything."""
    if not keywords:
        return F.lit(True)
    return bind(alert_text(columns), lambda text: reduce(or_, [F.contains(text, F.lit(k.lower())) for k in keywords]))
