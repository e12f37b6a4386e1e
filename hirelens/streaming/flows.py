"""Streaming forms: incremental ingest, de-duplication, weekly counts, alerts, run metrics."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hirelens import fixed_values as V
from hirelens.functions.skills import Taxonomy
from hirelens.operators.alerts import alert_matches
from hirelens.plans.batch import RunStats, store_run
from hirelens.plans.store import JobStore


def read_folder(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; each file is read once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def weekly_counts(stream: DataFrame, time: str = "ts", delay: str = "1 day") -> DataFrame:
    """Rows per week ending on Sunday; a week is emitted once the watermark has passed it.

    The epoch began on a Thursday, so weeks are shifted by four days to begin on Monday. Weeks
    still open stay out, as append mode must; ``weekly_postings`` is the full answer in batch form.
    """
    week = F.window(time, "7 days", "7 days", "4 days")
    return (
        stream.withWatermark(time, delay)
        .groupBy(week.alias("w"))
        .agg(F.count(F.lit(1)).alias("jobs"))
        .select(F.date_sub(F.to_date("w.end"), 1).alias("week"), "jobs")
    )


def first_sightings(stream: DataFrame, keys: Sequence[str], time: str = "scraped_at",
                    delay: str = "30 days") -> DataFrame:
    """One row per key as long as its repeats stay within the watermark; state is dropped after."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_end(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder: what is there now, or at an interval if given.

    The checkpoint makes intervals exclusive and merges missed ones.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _start(writer.option("path", path), every)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: a new checkpoint, even at an old path, has a new one."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def ingest(raw: DataFrame, store: JobStore, checkpoint: str, scraped_at: Column | None = None,
           taxonomy: Taxonomy = V.TAXONOMY, every: str | None = None,
           keywords: Sequence[str] = V.ALERT_KEYWORDS) -> StreamingQuery:
    """Raw postings stream -> job store; each micro-batch is one run: logged, stored, snapshotted, alerted.

    A micro-batch repeated after a failure finds its run id in the log and replaces its own
    rows; a new checkpoint only ever adds runs. Duplicates across runs are found exactly,
    against the stored jobs, so alerts are for new jobs only.
    """

    def save(batch: DataFrame, number: int) -> None:
        started = datetime.now(timezone.utc)
        origin = f"{stream_id(store.spark, checkpoint)}#{number}"
        stats = RunStats(run_id=store.start_run(started, origin))
        seen = F.lit(started).cast("timestamp") if scraped_at is None else scraped_at
        store_run(store, batch, stats, started, seen, keywords, taxonomy=taxonomy, origin=origin)

    writer = raw.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return _start(writer, every)


def alert_stream(new_jobs: DataFrame, path: str, checkpoint: str,
                 keywords: Sequence[str] = V.ALERT_KEYWORDS, every: str | None = None) -> StreamingQuery:
    """Append matching new jobs to the alerts folder."""
    return run_to_end(alert_matches(new_jobs, keywords), path, checkpoint, every)


def run_with_metrics(stream: DataFrame, path: str, metrics: str, checkpoint: str, *extra: Column,
                     every: str | None = None) -> StreamingQuery:
    """Append a stream to ``path`` and one row per micro-batch to ``metrics``: query_id, batch, records, extra counts.

    The counts ride along with the write. Rows are kept by the checkpoint's id and the batch number: a
    repeated micro-batch replaces its own rows in both folders, another checkpoint only adds.
    """
    spark = stream.sparkSession
    names = ["records", *(f"extra_{k}" for k in range(len(extra)))]

    def save(batch: DataFrame, number: int) -> None:
        own = f"query_id={stream_id(spark, checkpoint)}/batch={number}"
        seen = Observation()
        counts = [F.count(F.lit(1)), *extra]
        watched = batch.observe(seen, *[c.alias(n) for c, n in zip(counts, names)])
        watched.write.mode("overwrite").parquet(f"{path}/{own}")
        found = batch.sparkSession.range(1).select(*[F.lit(seen.get[n]).cast("long").alias(n) for n in names])
        found.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/{own}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return _start(writer, every)


def _start(writer, every: str | None) -> StreamingQuery:
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
