"""Hiring-thread comments -> raw postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.html import strip_tags, unescape
from hirelens.functions.text import bind, strip_ws, truncate
from hirelens.schemas import COMMENT, THREAD, envelope


def read_hits(spark: SparkSession, path: str, kind: str = "comment") -> DataFrame:
    """API pages landed as JSON lines -> one row per hit, missing fields null."""
    schema = envelope(COMMENT if kind == "comment" else THREAD)
    return spark.read.schema(schema).json(path).select(F.inline("hits"))


def damaged_lines(spark: SparkSession, path: str, kind: str = "comment") -> int:
    """Landed lines that are no JSON; ``read_hits`` finds no hit in them."""
    schema = envelope(COMMENT if kind == "comment" else THREAD).add("_corrupt_record", "string")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("page"))
    return parsed.filter(F.col("page._corrupt_record").isNotNull()).count()


def parse_hits(envelopes: DataFrame, column: str, kind: str = "comment") -> DataFrame:
    """The same from a column of JSON texts."""
    schema = envelope(COMMENT if kind == "comment" else THREAD)
    parsed = envelopes.select(F.from_json(column, schema).alias("page"))
    return parsed.select(F.inline("page.hits"))


def hiring_threads(threads: DataFrame, limit: int = 1, order: str = "ordinal") -> DataFrame:
    """The first ``limit`` threads, in input order, whose title asks who is hiring."""
    asks = threads.filter(F.startswith(F.lower("title"), F.lit(V.HIRING_THREAD_PREFIX)))
    return asks.orderBy(order).limit(limit)


def top_level_comments(comments: DataFrame, threads: DataFrame) -> DataFrame:
    """Direct answers to the chosen threads, with the thread title; replies drop out.

    ``threads`` comes out of a limit, but the join carries no hint: Spark checks its size.
    """
    chosen = threads.select(F.col("objectID").alias("parent_id"), F.col("title").alias("thread_title"))
    keyed = comments.withColumn("parent_id", F.col("parent_id").cast("string"))
    return keyed.join(chosen, "parent_id").select(*comments.columns, "thread_title")


def split_header(header: Column) -> Column:
    """``Company | Role | Location | ...`` -> struct(company, title, location), else null."""
    parts = F.filter(F.transform(F.split(header, r"\|"), strip_ws), lambda p: p != "")

    def fields(p: Column) -> Column:
        first = F.get(p, F.lit(0))
        roles = F.filter(F.slice(p, 2, F.size(p)), lambda part: part.rlike(V.ROLE_WORDS))
        # Position in ``p`` of the first role, else of the part after the company.
        title_at = F.when(
            F.size(roles) > 0, F.array_position(F.slice(p, 2, F.size(p)), F.get(roles, F.lit(0))).cast("int")
        ).otherwise(F.lit(1))

        def with_place(at: Column) -> Column:
            # Positions are compared, not texts: a second part equal to the title may be the place.
            place = F.filter(
                p,
                lambda part, i: (i > 0) & (i != at) & ~part.rlike(V.SALARY_HINT) & ~part.rlike(V.NON_LOCATION),
            )
            return F.struct(
                first.alias("company"), F.get(p, at).alias("title"), F.get(place, F.lit(0)).alias("location")
            )

        usable = (F.size(p) >= 2) & (F.length(first) <= V.MAX_COMPANY_CHARS)
        return F.when(usable, bind(title_at, with_place))

    return F.when(F.length(header) <= V.MAX_HEADER_CHARS, bind(parts, fields))


def text_lines(text: Column) -> Column:
    """Non-blank, trimmed lines."""
    return F.filter(F.transform(F.split(text, "\n"), strip_ws), lambda x: x != "")


def parse_comments(comments: DataFrame, max_chars: int = V.MAX_DESCRIPTION_CHARS,
                   source: str = V.COMMENT_SOURCE) -> DataFrame:
    """One raw posting per comment whose first line is a job header; others give no row."""
    kept = [c for c in ("ordinal",) if c in comments.columns]
    bare = comments.select(*kept, "objectID", "created_at", strip_tags(F.col("comment_text")).alias("bare"))
    texts = bare.select(*kept, "objectID", "created_at", unescape(F.col("bare")).alias("text"))
    lines = texts.select(*kept, "objectID", "created_at", text_lines(F.col("text")).alias("lines"))
    # Unrolling the header, instead of filtering on it, computes it once.
    header = split_header(F.get("lines", F.lit(0)))
    headed = lines.select("*", F.explode(F.array_compact(F.array(header))).alias("header"))
    return headed.select(
        *kept,
        F.lit(source).alias("source"),
        F.col("header")["title"].alias("title"),
        F.col("header")["company"].alias("company"),
        F.col("header")["location"].alias("location"),
        F.col("created_at").alias("posted"),
        F.when(F.col("objectID") != "", F.concat(F.lit(V.COMMENT_URL_PREFIX), F.col("objectID"))).alias("url"),
        truncate(F.array_join("lines", "\n"), max_chars).alias("description"),
    )


def parse_comments_counted(comments: DataFrame, max_chars: int = V.MAX_DESCRIPTION_CHARS,
                           source: str = V.COMMENT_SOURCE) -> tuple[DataFrame, list[Observation]]:
    """Postings, and counters ``comments`` and ``parsed`` that ride along: their quotient is the parse rate.

    The counters are there after an action on the postings.
    """
    read, parsed = Observation(), Observation()
    postings = parse_comments(comments.observe(read, F.count(F.lit(1)).alias("comments")), max_chars, source)
    return postings.observe(parsed, F.count(F.lit(1)).alias("parsed")), [read, parsed]


def parse_rate(counters: dict[str, int]) -> float | None:
    """Share of the comments that are postings; none without comments."""
    return counters["parsed"] / counters["comments"] if counters.get("comments") else None
