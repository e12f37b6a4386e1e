"""Enrichment of cleaned postings from their free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.flags import detect_remote, detect_seniority, remote_scope
from hirelens.functions.salary import extract_salary
from hirelens.functions.skills import Taxonomy, best_choice, extract_skills, fuzzy_tokens


def posting_text() -> Column:
    """Title and description, the text all extractors but two read."""
    empty = F.lit("")
    return F.concat_ws("\n", F.coalesce("title", empty), F.coalesce("description", empty))


def enrich(cleaned: DataFrame, taxonomy: Taxonomy = V.TAXONOMY, fuzzy: bool = True,
           threshold: int = V.FUZZY_THRESHOLD, gazetteer: DataFrame | None = None) -> DataFrame:
    """Add skills, salary, remote flag and seniority; with a gazetteer also fill gaps.

    Every extractor is a column expression, so this step needs no shuffle; only the
    optional gazetteer joins.
    """
    text = posting_text()
    tagged = cleaned.withColumns(
        {
            "skills": extract_skills(text, taxonomy, fuzzy, threshold),
            "_salary": extract_salary(text),
            "remote": detect_remote(remote_scope(F.col("title"), F.col("location"), F.col("description"))),
            "seniority": detect_seniority(F.col("title")),
        }
    )
    priced = tagged.withColumns(
        {
            "salary_min": F.col("_salary")["low"],
            "salary_max": F.col("_salary")["high"],
            "salary_currency": F.col("_salary")["currency"],
        }
    ).drop("_salary")
    return priced if gazetteer is None else fill_entities(priced, gazetteer)


def fuzzy_vocabulary(texts: DataFrame, text: Column, taxonomy: Taxonomy = V.TAXONOMY,
                     threshold: int = V.FUZZY_THRESHOLD) -> DataFrame:
    """(token, name, skill, ratio) for every distinct word that nearly spells a name.

    Words that cannot match are dropped before the shuffle, and equal ones merge map-side.
    """
    skills = F.array(*[F.lit(s) for s in taxonomy])
    words = texts.select(F.explode(fuzzy_tokens(text, taxonomy, threshold)).alias("token")).distinct()
    scored = words.withColumn("best", best_choice(F.col("token"), taxonomy, threshold))
    return scored.filter("best is not null").select(
        "token",
        F.col("best")["name"].alias("name"),
        F.get(skills, F.col("best")["position"]).alias("skill"),
        F.col("best")["ratio"].alias("ratio"),
    )


def _run_codes(words: Column) -> list[Column]:
    """Two 64-bit hashes of a run of words: together they stand for its text."""
    return [F.xxhash64(words).alias("_code"), F.xxhash64(words, F.lit("check")).alias("_check")]


def entity_mentions(records: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(job_id, company, location): first organisation and first place named in each text.

    ``gazetteer`` has ``name`` (words of any number) and ``kind`` ('ORG' or 'GPE'). For each number of
    words that a name has, each run of so many words of a text becomes a hash, and the hashes look up the
    names. Only (job_id, place, two hashes) leave a record, never its words. The gazetteer's size is not
    assumed: the join carries no hint, Spark broadcasts it only below its own size limit and otherwise
    shuffles both sides, splitting frequent runs. Of several names at one place the longest counts.
    """
    text = F.left(posting_text(), F.lit(V.ENTITY_SCOPE_CHARS))
    words = F.filter(
        F.transform(F.split(text, r"\s+"), lambda w: F.regexp_replace(w, r"^[^\w#@]+|[^\w#+]+$", "")),
        lambda w: w != "",
    )
    parts = F.split("name", " ")
    names = gazetteer.select("name", "kind", F.size(parts).alias("_size"), *_run_codes(parts)).distinct()
    # One number for each length of a name, at most as many as a text can have words.
    sizes = sorted(r[0] for r in names.select("_size").where(F.col("_size") <= V.ENTITY_SCOPE_CHARS).distinct().collect())

    def runs(listed: Column) -> Column:
        found = [F.transform(
            F.sequence(F.lit(1), F.size(listed) - size + 1), lambda at: F.struct(
                at.alias("at"), *_run_codes(F.slice(listed, at, size)))) for size in sizes]
        nothing = F.array().cast("array<struct<at:int,_code:bigint,_check:bigint>>")
        return F.concat(nothing, *[F.when(F.size(listed) >= size, f).otherwise(nothing) for size, f in zip(sizes, found)])

    mentions = records.select("job_id", words.alias("_words")).select("job_id", F.inline(runs(F.col("_words")))).join(
        names, ["_code", "_check"])

    def first_of(kind: str) -> Column:
        place = F.when(F.col("kind") == kind, F.struct("at", -F.length("name"), "name"))
        return F.min(place)["name"]

    return mentions.groupBy("job_id").agg(
        first_of("ORG").alias("_org"), first_of("GPE").alias("_gpe")
    )


def fill_entities(records: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Fill a missing company or location from the first entity in the text; job_id stays."""
    gaps = records.filter(F.col("company").isNull() | F.col("location").isNull())
    found = entity_mentions(gaps, gazetteer).withColumnRenamed("job_id", "_id")
    # Null-safe, so that no null filter is pushed into one side only: both sides then read the
    # same shuffle of the records instead of computing it twice.
    joined = records.join(found, F.col("job_id").eqNullSafe(F.col("_id")), "left")
    return joined.withColumns(
        {"company": F.coalesce("company", "_org"), "location": F.coalesce("location", "_gpe")}
    ).select(*records.columns)
