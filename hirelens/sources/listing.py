"""Listing pages -> raw postings."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens import fixed_values as V
from hirelens.functions.html import element_matches, resolve_url, selector_tags, shred
from hirelens.session import shared_dir
from hirelens.sources.tables import TASKS_A_CORE

Selectors = Mapping[str, Sequence[str]]

# Splits of a folder of small files that a task reads: Spark counts each file as 4 MB or more, 32 to a split.
SPLITS_A_TASK = 16
# Files with these endings are unpacked by Spark's text reader, which takes several times as long a file as its binary reader.
PACKED = ("gz", "bz2", "deflate", "lz4", "snappy", "zst")


def land_pages(pages: DataFrame, path: str) -> None:
    """Land pages (page_id, html) as one HTML file each; equal ids of a task share a file.

    In a folder that tasks see as their own they write the files themselves, each moved into place when whole, as
    Hadoop's local file system starts several processes a file to set modes. Elsewhere Spark's writer does it.
    """
    spark = pages.sparkSession
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = pages.select("page_id", "html")
    if system.getScheme() != "file":
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("page_id").text(path)
        return
    folder = system.makeQualified(location).toUri().getPath()
    system.mkdirs(location)

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools
        import os

        from pyspark import TaskContext

        task = TaskContext.get()
        landed = 0
        held = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())))
        for number, group in itertools.groupby(held, lambda row: row[0]):
            name = f"page-{'null' if number is None else number}-{task.partitionId():05d}.html"
            # Hidden from readers until it is whole.
            begun = f"{folder}/.{name}.{task.taskAttemptId()}"
            with open(begun, "wb") as file:
                for _, text in group:
                    file.write((text.as_py() or b"") + b"\n")
            os.replace(begun, f"{folder}/{name}")
            landed += 1
        yield pa.record_batch([pa.array([landed], pa.int64())], ["landed"])

    rows.sortWithinPartitions("page_id").mapInArrow(land, "landed long").agg(F.sum("landed")).collect()


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages: a Parquet table (page_id, url, html), or one HTML file per page.

    Files are numbered in the order of their paths, with numbers in a path compared as numbers, so
    page10 follows page9 and files with equal names in two folders stay apart. For that the paths
    alone are sorted into a table; a page's number is its row there, counted over that table's files.
    The files are read when this is called.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    name = F.col("_metadata.file_path").alias("url")
    files = spark.read.format("binaryFile").load(path).select(name, F.col("content").alias("html"))
    # Opening a file costs far more than its few bytes, so each is opened once and all else reads this table.
    stored = shared_dir(spark, "page-table")
    tasks = max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, files.rdd.getNumPartitions() // SPLITS_A_TASK)
    files.coalesce(tasks).write.parquet(stored)
    files = spark.read.schema(files.schema).parquet(stored).withColumn("html", F.col("html").cast("string"))
    packed = F.col("url").rlike(rf"\.({'|'.join(PACKED)})$")
    if not files.where(packed).isEmpty():
        unpacked = spark.read.text(path, wholetext=True, pathGlobFilter=f"*.{{{','.join(PACKED)}}}")
        files = files.where(~packed).unionByName(unpacked.select(name, F.col("value").alias("html")))
    # Dealt by path: the join with the numbers (no broadcast, whatever the size) moves pages no further, and
    # their parsing has as many tasks.
    files = files.repartition(tasks, "url")
    # Every digit run is left-padded, so that text order is number order.
    padded = F.array_join(F.transform(F.regexp_extract_all("url", F.lit(r"\d+|\D+"), F.lit(0)), lambda part: F.when(
        part.rlike(r"^\d"), F.lpad(part, 20, "0")).otherwise(part)), "")
    order = shared_dir(spark, "page-order")
    spark.read.schema("url string").parquet(stored).withColumn("_order", padded).orderBy("_order", "url").select("url").write.parquet(order)
    rows = spark.read.parquet(order).select("url", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per file of the sorted table.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.join(sizes, "_file").select("url", (F.col("_before") + F.col("_row")).alias("page_id"))
    return files.join(numbered.hint("merge"), "url").select("page_id", "url", "html")


def page_elements(pages: DataFrame, tags: Sequence[str] | None = None) -> DataFrame:
    """(page_id, seq, end_seq, tag, classes, attrs, text), one row per element."""
    shredded = pages.select("page_id", shred(F.col("html"), tags).alias("elements"))
    return shredded.select("page_id", F.inline("elements"))


def _blank_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _first_text(inside: Column, elements: Column, selectors: Sequence[str], read) -> Column:
    """First selector whose first element yields a value."""
    firsts = [
        read(F.get(F.filter(inside, lambda e: element_matches(e, s, elements)), F.lit(0)))
        for s in selectors
    ]
    return F.coalesce(*firsts) if firsts else F.lit(None).cast("string")


def _last_link(inside: Column, elements: Column, selectors: Sequence[str]) -> Column:
    """Last linked element under the first selector that has any."""
    links = [
        F.try_element_at(
            F.filter(
                inside,
                lambda e: element_matches(e, s, elements) & (F.coalesce(e["attrs"]["href"], F.lit("")) != ""),
            ),
            F.lit(-1),
        )["attrs"]["href"]
        for s in selectors
    ]
    return F.coalesce(*links) if links else F.lit(None).cast("string")


def parse_listing(pages: DataFrame, selectors: Selectors = V.SELECTORS, base_url: Column | None = None,
                  source: str = V.LISTING_SOURCE) -> DataFrame:
    """One raw posting per titled card. The first card selector with a match serves the page.

    A page stays one row until its cards are found, so nothing is shuffled. ``ordinal``
    follows page, then position: page numbers stay below 10**10, cards of a page below 10**6.
    """
    base = F.col("url") if base_url is None else base_url
    tags = selector_tags([s for chain in selectors.values() for s in chain])
    shredded = pages.select("page_id", base.alias("base"), shred(F.col("html"), tags).alias("elements"))
    elements = F.col("elements")

    sets = [F.filter(elements, lambda e: element_matches(e, s, elements)) for s in selectors["card"]]
    cards = F.coalesce(*[F.when(F.size(s) > 0, s) for s in sets])

    def read_card(card: Column) -> Column:
        inside = F.slice(elements, card["seq"] + 2, card["end_seq"] - card["seq"])

        def text(field: str) -> Column:
            return _first_text(inside, elements, selectors.get(field, []), lambda e: _blank_null(e["text"]))

        posted = _first_text(
            inside, elements, selectors.get("posted", []),
            lambda e: F.coalesce(_blank_null(e["attrs"]["datetime"]), _blank_null(e["text"])),
        )
        return F.struct(
            text("title").alias("title"),
            text("company").alias("company"),
            text("location").alias("location"),
            posted.alias("posted"),
            _last_link(inside, elements, selectors.get("link", [])).alias("href"),
        )

    found = shredded.select("page_id", "base", F.posexplode(F.transform(cards, read_card)).alias("at", "card"))
    return found.filter(F.col("card")["title"].isNotNull()).select(
        (F.col("page_id") * 1_000_000 + F.col("at")).cast("long").alias("ordinal"),
        F.lit(source).alias("source"),
        F.col("card")["title"].alias("title"),
        F.col("card")["company"].alias("company"),
        F.col("card")["location"].alias("location"),
        F.col("card")["posted"].alias("posted"),
        F.when(F.col("card")["href"].isNotNull(), resolve_url(F.col("base"), F.col("card")["href"])).alias("url"),
        F.lit(None).cast("string").alias("description"),
    )


def allowed_pages(pages: DataFrame, rules: DataFrame, respect: bool = True) -> DataFrame:
    """Keep pages their host's rules allow; see ``url_allowed``."""
    return url_allowed(pages, rules, respect).filter("allowed").drop("allowed")


def url_allowed(pages: DataFrame, rules: DataFrame, respect: bool = True) -> DataFrame:
    """Add ``allowed``: the first rule of the host whose prefix starts the path decides.

    ``rules`` is (host, ord, prefix, allow), any number a host. A path is expanded into its prefixes of
    the lengths that the rules of its host have, and these are joined with the rules by equality; so
    no list of rules is compared one by one. Equal paths of a host are decided once. Hosts with many
    paths, or prefixes with many rules, are rows that Spark's skew join may split.
    """
    if not respect:
        return pages.withColumn("allowed", F.lit(True))
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(.*)$", 1)
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    keyed = pages.withColumns({"_host": host, "_path": F.when(path == "", F.lit("/")).otherwise(path)})
    # The first of equal prefixes is the only one that can decide; empty ones say nothing.
    first = rules.where(F.col("prefix") != "").groupBy(F.col("host").alias("_host"), F.col("prefix").alias("_prefix")).agg(
        F.min(F.struct("ord", "allow")).alias("_rule"))
    # At most one length a letter of the longest path that counts.
    lengths = first.groupBy("_host").agg(F.collect_set(F.length("_prefix")).alias("_lengths"))
    prefixes = keyed.select("_host", "_path").distinct().join(lengths, "_host").select(
        "_host", "_path", F.explode(F.filter("_lengths", lambda n: n <= F.length("_path"))).alias("_n")).withColumn(
        "_prefix", F.expr("substring(_path, 1, _n)"))
    decided = prefixes.join(first, ["_host", "_prefix"]).groupBy("_host", "_path").agg(F.min("_rule").alias("_rule"))
    # Only what is forbidden is looked up: the rest is allowed anyway.
    forbidden = decided.where(~F.col("_rule.allow")).select("_host", "_path", F.lit(False).alias("_no"))
    return keyed.join(forbidden, ["_host", "_path"], "left").select(*pages.columns, F.col("_no").isNull().alias("allowed"))
