"""Exact duplicates of normalised texts by a stateful stream.

Each row first shrinks to a digest, its length and its place. A structured stream reads these
narrow rows and keeps one state per digest in RocksDB, without expiry: the best row so far (its
stable identifier, length and content locator) and a count. After the stream has ended, rows
meet their digest's state; every row whose digest is shared is compared with the text of its
state's row in full, so that a digest collision never merges different texts.

Only DataFrame functions and a native stateful aggregation are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import stored
from hirelens.session import shared_dir
from hirelens.sources.tables import read_parquet

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small states: no disk space reserved ahead for each of them.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# The characters that normalisation deletes.
WHITE = " \t\n\x0b\f\r"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def sha256(text: Column) -> Column:
    """Digest of a normalised text: 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def content_rows(docs: DataFrame, id_col: str, text_col: str, digest=sha256, locator: Column | None = None) -> DataFrame:
    """One narrow row per input row: digest, code points of the original, identifier, place.

    The place names the row for good (also among rows that repeat an identifier): file and
    position in it, which every file-backed frame offers, unless ``locator`` gives another one.
    """
    text = F.col(text_col)
    return docs.select(
        digest(normalised(text)).alias("digest"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("points"),
        F.col(id_col).cast("long").alias("doc_id"), _place(locator))


def _place(locator: Column | None) -> Column:
    if locator is None:
        locator = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return locator.alias("place")


def rank() -> Column:
    """Smallest for the row that stays: longest original, smallest identifier (null last), first place."""
    return F.struct((-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"),
                    F.col("doc_id").alias("doc_id"), F.col("place").alias("place"))


def fold_state(rows: DataFrame) -> DataFrame:
    """State per digest: the best row and the number of rows. The same for batch and stream."""
    return rows.groupBy("digest").agg(F.min(rank()).alias("best"), F.count(F.lit(1)).alias("seen"))


def run_stream(spark: SparkSession, folder: str, schema, checkpoint: str, out: str, files_per_batch: int | None = None) -> None:
    """Read all narrow rows in ``folder`` not seen before, update the state, write the changed states to ``out``.

    A later call with the same checkpoint continues the state; a batch repeated after a failure
    overwrites its own folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        query = (
            fold_state(reader.parquet(folder)).writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda frame, number: frame.write.mode("overwrite").parquet(f"{out}/batch={number}"))
            .start())
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def newest_states(spark: SparkSession, out: str) -> DataFrame:
    """Per digest the state of the last batch that changed it."""
    states = spark.read.option("basePath", out).parquet(out)
    return states.groupBy("digest").agg(
        F.max(F.struct("batch", "seen", "best")).alias("last")).select("digest", "last.best", "last.seen")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
          locator: Column | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Per input row: doc_id, place, digest, keep_id, keep_place, group_size, kept.

    A null text counts as empty; empty texts equal each other. Rows with a null identifier take
    part and stay only if no equal row has one. Repeated rows are rows of their own: one stays.
    An empty table gives no rows. Columns other than the two named ones are not touched, so
    their names can't clash.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "dedup-rows")
    content_rows(docs, id_col, text_col, digest, locator).write.parquet(folder)
    rows = spark.read.parquet(folder)
    out = shared_dir(spark, "dedup-states")
    if not rows.isEmpty():
        run_stream(spark, folder, rows.schema, shared_dir(spark, "dedup-stream"), out, files_per_batch)
        states = newest_states(spark, out)
    else:
        states = fold_state(rows)
    states = stored(states, "dedup-newest")
    differing = stored(_hits_that_differ(docs, states, text_col, digest, locator), "dedup-differing")
    decided = rows.join(states, "digest")
    if not differing.isEmpty():
        decided = _split_collisions(docs, decided, differing, text_col, digest, locator)
    return decided.select(
        "doc_id", "place", "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.place").alias("keep_place"),
        F.col("seen").alias("group_size"), (F.col("place") == F.col("best.place")).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of a file-backed frame that stay, with all their columns."""
    staying = dedup(docs, id_col, text_col).where("kept").select(F.col("place").alias("__place"))
    return docs.withColumn("__place", _place(None)).join(staying, "__place", "left_semi").drop("__place")


def _hits_that_differ(docs, states, text_col, digest, locator) -> DataFrame:
    """Digests under which some text differs from the text at the state's locator: full bytes, hits only."""
    shared = states.where(F.col("seen") > 1).select("digest", "best")
    texts = _texts(docs, text_col, digest, locator)
    hits = stored(texts.join(shared, "digest"), "dedup-hits")
    first = hits.where(F.col("place") == F.col("best.place")).select("digest", F.col("content").alias("first"))
    others = hits.where(F.col("place") != F.col("best.place")).select("digest", "content")
    # Written before the distinct: so the join alone may split a digest with many rows.
    return stored(others.join(first, "digest").where(F.col("content") != F.col("first")).select("digest"),
                  "dedup-unequal").distinct()


def _texts(docs, text_col, digest, locator) -> DataFrame:
    content = normalised(F.col(text_col))
    return docs.select(digest(content).alias("digest"), _place(locator), content.alias("content"))


def _split_collisions(docs, decided, differing, text_col, digest, locator) -> DataFrame:
    """Rows under digests that hold several texts are grouped by the whole text instead."""
    clean = decided.join(differing, "digest", "left_anti")
    texts = _texts(docs, text_col, digest, locator).join(differing, "digest", "left_semi")
    mixed = decided.select("digest", "points", "doc_id", "place").join(texts, ["digest", "place"])
    groups = mixed.groupBy("digest", "content").agg(F.min(rank()).alias("best"), F.count(F.lit(1)).alias("seen"))
    return clean.unionByName(mixed.join(groups, ["digest", "content"]).drop("content"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with the row that stays for its text."""
    found = dedup(read_parquet(spark, f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


EXACT_DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
