"""Cleaning, keep-first de-duplication and record validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.dates import parse_date_text
from hirelens.functions.text import (
    job_id,
    nfkc_list,
    normalize_text,
    standardize_location,
    truncate,
    web_url_only,
)
from hirelens.session import short_methods


def clean(raw: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Raw postings -> cleaned postings with identity; rows without a title are dropped.

    ``raw`` has the raw-posting columns; missing ones count as null. ``ordinal`` is kept.
    """
    present = set(raw.columns)

    def field(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    texts = ["source", "title", "company", "location", "posted", "url", "description"]
    kept = [c for c in raw.columns if c not in texts and c != "scraped_at"]
    if scraped_at is None:
        scraped_at = F.col("scraped_at") if "scraped_at" in present else F.current_timestamp()
    short_methods(raw.sparkSession)
    # Evaluated once, in a step of its own.
    composed = raw.select(*kept, scraped_at.alias("scraped_at"), *[field(t).alias(t) for t in texts],
                          nfkc_list([field(t) for t in texts]).alias("_nfkc"))
    normal = composed.select(
        *kept, "scraped_at", *[normalize_text(F.col(t), F.get("_nfkc", F.lit(i))).alias(t) for i, t in enumerate(texts)]
    ).filter(F.col("title").isNotNull())
    typed = normal.select(
        *kept,
        F.coalesce("source", F.lit(V.UNKNOWN_SOURCE)).alias("source"),
        truncate(F.col("title"), V.MAX_TITLE_CHARS).alias("title"),
        "company",
        standardize_location(F.col("location")).alias("location"),
        parse_date_text(F.col("posted")).alias("posted_date"),
        web_url_only(F.col("url")).alias("url"),
        "description",
        "scraped_at",
    )
    identity = job_id(*[F.col(c) for c in ("source", "title", "company", "location", "url")])
    return typed.select(identity.alias("job_id"), *typed.columns)


def keep_first(df: DataFrame, key: str = "job_id", order: str = "ordinal") -> DataFrame:
    """One row per key, the earliest in input order.

    The aggregation runs map-side first, so a posting repeated millions of times reaches
    the shuffle once per task.
    """
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("first"))
    return first.select(*[F.col(key) if c == key else F.col("first")[c].alias(c) for c in df.columns])


# --- validation -------------------------------------------------------------------------


def _positive(c: Column) -> Column:
    number = c.try_cast("double")
    return F.when((number > 0) & ~F.isnan(number), number)


def violations(columns: list[str]) -> Column:
    """Names of the record rules a row breaks."""

    def rule(name: str, column: str, broken: Column) -> list[Column]:
        return [F.when(broken, F.lit(name))] if column in columns else []

    def not_number(name: str) -> Column:
        c = F.col(name)
        return c.isNotNull() & c.try_cast("double").isNull()

    title = F.col("title")
    rules = [
        *rule("job_id_missing", "job_id", F.col("job_id").isNull()),
        *rule("source_missing", "source", F.col("source").isNull()),
        *rule("title_blank", "title", title.isNull() | ~title.rlike(r"(?U)[^\s\x1c-\x1f]")),
        *rule("remote_missing", "remote", F.col("remote").isNull()),
        *rule("salary_min_not_number", "salary_min", not_number("salary_min")),
        *rule("salary_max_not_number", "salary_max", not_number("salary_max")),
        *rule("scraped_at_missing", "scraped_at", F.col("scraped_at").isNull()),
    ]
    return F.array_compact(F.array(*rules))


def check(records: DataFrame) -> DataFrame:
    """Add ``violations`` and put the fields of sound rows into their final form."""
    checked = records.withColumn("violations", violations(records.columns))
    final: dict[str, Column] = {"title": F.regexp_replace("title", rf"^{V.WHITESPACE}+|{V.WHITESPACE}+$", "")}
    for name in ("salary_min", "salary_max"):
        if name in records.columns:
            final[name] = _positive(F.col(name))
    if "skills" in records.columns:
        final["skills"] = F.coalesce("skills", F.array().cast("array<string>"))
    return checked.select(
        *[
            F.when(F.size("violations") == 0, final[c]).otherwise(F.col(c).try_cast("double")
              if c.startswith("salary_m") else F.col(c)).alias(c) if c in final else F.col(c)
            for c in checked.columns
        ]
    )


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantine with the broken rules)."""
    checked = records.withColumn("violations", violations(records.columns))
    valid = check(records).filter(F.size("violations") == 0).drop("violations")
    return valid, checked.filter(F.size("violations") > 0)
