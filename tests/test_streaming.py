from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hirelens.plans.batch import process_raw
from hirelens.plans.store import JobStore
from hirelens.schemas import RAW_POSTING
from hirelens.streaming import flows, metrics

def seen():
    return F.lit("2026-03-01 12:00:00").cast("timestamp")


def postings(spark, start, stop):
    return spark.range(start, stop).select(
        F.col("id").alias("ordinal"), F.lit("s").alias("source"),
        F.concat_ws(" ", F.lit("Engineer"), (F.col("id") % 7).cast("string")).alias("title"),
        *[F.lit(None).cast("string").alias(c) for c in ("company", "location", "posted", "url")],
        F.lit("Python and Go").alias("description"),
    )


def test_ingest_equals_batch_and_resumes(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), JobStore(spark, str(tmp_path / "store"))
    for part in ((0, 3), (2, 5)):
        postings(spark, *part).coalesce(1).write.mode("append").parquet(landing)

    def ingest():
        stream = flows.read_folder(spark, landing, RAW_POSTING, files_per_batch=1)
        flows.ingest(stream, store, str(tmp_path / "checkpoint"), seen()).awaitTermination()

    ingest()
    assert store.first_records().select("run_id").distinct().count() == 2
    postings(spark, 4, 12).coalesce(1).write.mode("append").parquet(landing)
    ingest()
    ingest()
    whole = process_raw(postings(spark, 0, 12), seen()).valid
    got = store.first_records()
    assert sorted(r.job_id for r in got.collect()) == sorted(r.job_id for r in whole.collect())
    assert got.count() == 7


def test_weeks_are_emitted_once_passed(spark, tmp_path):
    landing = str(tmp_path / "landing")
    days = [datetime(2024, 1, 1) + timedelta(days=d) for d in range(16)]
    rows = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    rows.coalesce(1).write.parquet(landing)
    stream = flows.read_folder(spark, landing, rows.schema)
    path = str(tmp_path / "out")
    flows.run_to_end(flows.weekly_counts(stream), path, str(tmp_path / "checkpoint")).awaitTermination()
    got = sorted((r.week, r.jobs) for r in spark.read.parquet(path).collect())
    assert got == [(date(2024, 1, 7), 7), (date(2024, 1, 14), 7)]


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for day in (1, 2):
        rows = spark.createDataFrame([("a", datetime(2024, 1, day)), ("b" * day, datetime(2024, 1, day))], "job_id string, scraped_at timestamp")
        rows.coalesce(1).write.mode("append").parquet(landing)
    stream = flows.read_folder(spark, landing, rows.schema, files_per_batch=1)
    out, metrics = str(tmp_path / "out"), str(tmp_path / "metrics")
    flows.run_with_metrics(flows.first_sightings(stream, ["job_id"]), out, metrics, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.job_id for r in spark.read.parquet(out).collect()) == ["a", "b", "bb"]
    assert sum(r.records for r in spark.read.parquet(metrics).collect()) == 3


def test_every_micro_batch_has_its_metrics(spark, tmp_path):
    landing = str(tmp_path / "landing")
    spark.range(104).repartition(104, "id").write.option("maxRecordsPerFile", 1).parquet(landing)
    files = spark.read.parquet(landing).select("_metadata.file_path").distinct().count()
    assert files > 100
    stream = flows.read_folder(spark, landing, spark.range(1).schema, files_per_batch=1)
    metrics = str(tmp_path / "metrics")
    flows.run_with_metrics(stream, str(tmp_path / "out"), metrics, str(tmp_path / "checkpoint"), F.count_if(F.col("id") < 4)).awaitTermination()
    rows = spark.read.parquet(metrics)
    assert rows.filter("records > 0").count() == files
    assert rows.agg(F.sum("records"), F.sum("extra_0")).first() == (104, 4)


def test_a_new_checkpoint_only_adds_runs(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), JobStore(spark, str(tmp_path / "store"))
    postings(spark, 0, 3).coalesce(1).write.parquet(landing)
    assert store.start_run(datetime(2026, 1, 1)) == 1
    store.save_records(process_raw(postings(spark, 5, 6), seen()).valid, 1)
    for checkpoint in ("one", "two"):
        stream = flows.read_folder(spark, landing, RAW_POSTING)
        flows.ingest(stream, store, str(tmp_path / checkpoint), seen()).awaitTermination()
    first = {r.run_id: r.n for r in store.first_records().groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert first == {1: 1, 2: 3}
    log = {r.run_id: (r.status, r.records_fetched, r.records_new) for r in store.runs().collect()}
    assert log[2] == ("success", 3, 3) and log[3] == ("success", 3, 0)
    assert store.market_snapshots().filter("run_id = 3").first().total_jobs == 4


def test_a_repeated_micro_batch_keeps_its_run(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    started = datetime(2026, 1, 1)
    assert [store.start_run(started, o) for o in ("q#0", "q#1", "q#0", "p#0")] == [1, 2, 1, 3]


def test_metrics_of_two_checkpoints_in_one_folder(spark, tmp_path):
    out, counts = str(tmp_path / "out"), str(tmp_path / "metrics")
    for name, start in (("one", 0), ("two", 100)):
        landing = str(tmp_path / name)
        spark.range(start, start + 5).coalesce(1).write.parquet(landing)
        stream = flows.read_folder(spark, landing, spark.range(1).schema)
        flows.run_with_metrics(stream, out, counts, str(tmp_path / f"c-{name}")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [*range(5), *range(100, 105)]
    rows = spark.read.parquet(counts)
    assert rows.agg(F.sum("records")).first()[0] == 10 and rows.select("query_id").distinct().count() == 2


def test_listener_keeps_more_than_spark_does(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    counts = {"small": F.count_if(F.col("id") < 4)}
    log = metrics.ProgressLog(spark, str(tmp_path / "metrics"), counts)
    spark.streams.addListener(log)
    try:
        for name, files in (("one", 12), ("two", 5)):
            landing = str(tmp_path / name)
            spark.range(files).repartitionByRange(files, "id").write.parquet(landing)
            stream = metrics.watched(flows.read_folder(spark, landing, spark.range(1).schema, files_per_batch=1), counts)
            query = flows.run_to_end(stream, str(tmp_path / "out" / name), str(tmp_path / f"c-{name}"))
            log.wait(query)
            assert len(query.recentProgress) <= 3
    finally:
        spark.streams.removeListener(log)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = metrics.read_metrics(spark, log).filter("records > 0").groupBy("query_id").agg(
        F.count("*").alias("batches"), F.countDistinct("batch").alias("numbers"), F.sum("records").alias("records"),
        F.sum("small").alias("small"), F.sum("input_rows").alias("rows")).collect()
    got = sorted((r.batches, r.numbers, r.records, r.small, r.rows) for r in rows)
    assert got[0][2:] == (5, 4, 5) and got[1][2:] == (12, 4, 12) and got[1][0] == got[1][1] > 10


def test_listener_reports_failed_writes(spark, tmp_path):
    (tmp_path / "metrics").write_text("not a folder")
    log = metrics.ProgressLog(spark, str(tmp_path / "metrics"), {})
    spark.range(3).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(log)
    try:
        stream = metrics.watched(flows.read_folder(spark, str(tmp_path / "in"), spark.range(1).schema), {})
        query = flows.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "c"))
        with pytest.raises(RuntimeError):
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
