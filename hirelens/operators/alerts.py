"""Alert rows per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens import fixed_values as V
from hirelens.functions.formats import format_salary
from hirelens.operators.filters import matches_keywords


def alert_matches(new_jobs: DataFrame, keywords: Sequence[str] = V.ALERT_KEYWORDS) -> DataFrame:
    """New jobs that match any keyword.

    The verdict is a generated column, below which Spark pushes no filter: pushed down, the filter would
    clean and tag every posting a second time, once for each keyword.
    """
    verdict = F.struct(matches_keywords(new_jobs.columns, keywords).alias("_matches"))
    return new_jobs.select("*", F.inline(F.array(verdict))).filter("_matches").drop("_matches")


def alert_gate(new_jobs: DataFrame, keywords: Sequence[str] = V.ALERT_KEYWORDS,
               min_new: int = V.MIN_NEW_RECORDS, enabled: bool = True) -> DataFrame:
    """(run_id, total_new, matching) of the runs that send an alert."""
    counted = new_jobs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_new"),
        F.count_if(matches_keywords(new_jobs.columns, keywords)).alias("matching"),
    )
    return counted.filter(F.lit(enabled) & (F.col("total_new") >= min_new) & (F.col("matching") > 0))


def _salary() -> Column:
    return format_salary(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"))


def _join_parts(*parts: Column) -> Column:
    return F.concat_ws(" · ", *[F.nullif(p, F.lit("")) for p in parts])


def stored_alerts(new_jobs: DataFrame, keywords: Sequence[str] = V.ALERT_KEYWORDS,
                  min_new: int = V.MIN_NEW_RECORDS, enabled: bool = True) -> DataFrame:
    """All matches of the runs that send an alert, with the run's counts. Counts come from the gate, not a window.

    The gate, one narrow row a run, goes to the matches: shuffled by run, those of one run would all
    meet in one task.
    """
    gate = alert_gate(new_jobs, keywords, min_new, enabled)
    return alert_matches(new_jobs, keywords).join(F.broadcast(gate), "run_id")


def digest_of(matches: DataFrame, limit: int = V.DIGEST_ITEMS) -> DataFrame:
    """The first ``limit`` alerts of each run, in input order, as digest lines.

    The rank limit is applied map-side as well, so a run with very many matches sends only
    its first rows to the shuffle.
    """
    first = Window.partitionBy("run_id").orderBy("ordinal")
    top = matches.withColumn("position", F.row_number().over(first)).filter(F.col("position") <= limit)
    remote = F.when(F.col("remote"), F.lit("Remote"))
    mail = _join_parts(F.col("company"), F.col("location"), remote, _salary())
    brief = _join_parts(
        F.col("company"), F.when(F.col("remote"), F.lit("Remote")).otherwise(F.col("location")), _salary()
    )
    return top.select(
        "run_id",
        "position",
        "job_id",
        "title",
        "url",
        mail.alias("meta"),
        brief.alias("brief"),
        F.slice("skills", 1, V.DIGEST_SKILLS).alias("skills"),
        "total_new",
        "matching",
        F.greatest(F.col("matching") - limit, F.lit(0)).alias("more"),
    )


def digest_rows(new_jobs: DataFrame, keywords: Sequence[str] = V.ALERT_KEYWORDS, limit: int = V.DIGEST_ITEMS,
                min_new: int = V.MIN_NEW_RECORDS, enabled: bool = True) -> DataFrame:
    """The digest of each alerting run, from its new jobs."""
    return digest_of(stored_alerts(new_jobs, keywords, min_new, enabled), limit)


def alert_messages(new_jobs: DataFrame, keywords: Sequence[str] = V.ALERT_KEYWORDS,
                   limit: int = V.MESSAGE_ITEMS, max_chars: int = V.MESSAGE_CHARS) -> DataFrame:
    """(run_id, message): header line and the first matches of each alerting run as text."""
    rows = digest_rows(new_jobs, keywords, limit)
    line = F.concat(F.lit("• "), F.col("title"), F.lit(" - "), F.col("brief"))
    # At most ``limit`` lines per run.
    grouped = rows.groupBy("run_id", "total_new", "matching").agg(
        F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("lines")
    )
    header = F.concat(
        F.col("total_new").cast("string"), F.lit(" new job(s), "),
        F.col("matching").cast("string"), F.lit(" match your keywords"),
    )
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return grouped.select(
        "run_id", F.left(F.concat_ws("\n", header, body), F.lit(max_chars)).alias("message")
    )
