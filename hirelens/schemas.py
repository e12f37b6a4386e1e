"""Table schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


RAW_POSTING = _struct(
    ordinal=LongType(),
    source=StringType(),
    title=StringType(),
    company=StringType(),
    location=StringType(),
    posted=StringType(),
    url=StringType(),
    description=StringType(),
)

JOB = _struct(
    job_id=StringType(),
    source=StringType(),
    title=StringType(),
    company=StringType(),
    location=StringType(),
    remote=BooleanType(),
    seniority=StringType(),
    salary_min=DoubleType(),
    salary_max=DoubleType(),
    salary_currency=StringType(),
    skills=ArrayType(StringType()),
    posted_date=DateType(),
    url=StringType(),
    description=StringType(),
    scraped_at=TimestampType(),
)

# A job as kept in a batch: the record plus its place in the input.
OBSERVATION = StructType(JOB.fields + [StructField("ordinal", LongType()), StructField("run_id", LongType())])

RUN = _struct(
    run_id=LongType(),
    started_at=TimestampType(),
    finished_at=TimestampType(),
    status=StringType(),
    records_fetched=LongType(),
    records_new=LongType(),
    records_invalid=LongType(),
    errors=StringType(),
)

SKILL_SNAPSHOT = _struct(
    run_id=LongType(), snapshot_date=DateType(), skill=StringType(), job_count=LongType()
)

# salary_total and paid_jobs let the next run continue the average without a rescan.
MARKET_SNAPSHOT = _struct(
    run_id=LongType(),
    snapshot_date=DateType(),
    total_jobs=LongType(),
    remote_jobs=LongType(),
    avg_salary=DoubleType(),
    salary_total=DoubleType(),
    paid_jobs=LongType(),
)

COMMENT = _struct(
    objectID=StringType(),
    parent_id=StringType(),
    created_at=StringType(),
    comment_text=StringType(),
)

THREAD = _struct(objectID=StringType(), title=StringType())


def envelope(hit: StructType) -> StructType:
    """API page around the hits."""
    return StructType([StructField("hits", ArrayType(hit)), StructField("nbPages", LongType())])
