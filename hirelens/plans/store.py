"""Parquet tables of the job market, written per run so that a repeated run replaces itself.

    observations/run_id=N   every valid record of the batch
    jobs/run_id=N           records first seen in run N; never changed afterwards
    quarantine/run_id=N     records of the batch that break a rule, with the rules
    alerts/run_id=N         all new jobs of the run that match; the digest is a view of them
    skill_snapshots/run_id=N, market_snapshots/run_id=N
    runs                    appended log, the last row of a run wins
    claims/N                one empty file per run id ever given out
    bases/seq=S/bucket=B    the job table as of some run, hash-bucketed by job_id
    base_index/seq=S        Bloom bits of the base's ids, see operators/known_ids
    bases_log               appended log: which run each base covers, and when runs were written
    bases_claims/S          one empty file per number of that log

``first_seen`` comes from ``jobs``, ``last_seen`` from ``observations``, so a run writes in
proportion to its batch, never to the whole table. The job table is read as its newest base plus
the runs since. A base is written once the runs since the last one hold half as many rows as that,
so all bases together cost a small multiple of what is stored. A base is valid as long as no run that
it covers is written after the base was begun.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from hirelens import fixed_values as V
from hirelens.operators.alerts import digest_of, stored_alerts
from hirelens.operators.analytics import explode_skills
from hirelens.operators.clean import keep_first
from hirelens.operators.history import latest_runs, market_totals, new_records, with_average
from hirelens.operators.known_ids import bucket_of, build_index, chunks_for, known_among
from hirelens.schemas import MARKET_SNAPSHOT, OBSERVATION, RUN, SKILL_SNAPSHOT
from hirelens.session import finer_tasks

_RUN_LOG = StructType(RUN.fields + [StructField("seq", IntegerType()), StructField("origin", StringType())])
_ALERT = StructType(
    OBSERVATION.fields + [StructField("total_new", LongType()), StructField("matching", LongType())])
_SEEN = [StructField(c, OBSERVATION["scraped_at"].dataType) for c in ("first_seen", "last_seen")]
_BASE = StructType([f for f in OBSERVATION.fields if f.name != "scraped_at"] + _SEEN + [StructField("bucket", IntegerType())])
_BASE_INDEX = StructType([StructField("bucket", IntegerType()), StructField("chunk", IntegerType()), StructField("bits", BinaryType())])
# A row with a version tells of a base, one with a run_id of a run that has been written.
_BASE_LOG = StructType([StructField("seq", LongType()), StructField("version", LongType()), StructField("run_id", LongType()),
                        StructField("rows", LongType()), StructField("buckets", IntegerType()), StructField("chunks", IntegerType())])
# Rows of a bucket, rows since the last base under which no new one is due, and their share of its rows.
BUCKET_ROWS, FOLD_ROWS, FOLD_SHARE = 1_000_000, 100_000, 0.5
# Tasks that write a bucket of a base.
BUCKET_PARTS = 8
_QUARANTINE = StructType(OBSERVATION.fields + [StructField("violations", ArrayType(StringType()))])


def _location(spark: SparkSession, path: str):
    """(file system, path) as the cluster sees them."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty one of that schema if it does not exist yet."""
    system, location = _location(spark, path)
    if system.exists(location):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def csv_rows(records: DataFrame) -> DataFrame:
    """The fixed CSV columns as text: skills joined by "; ", True/False, ISO dates and UTC times."""
    utc = F.to_utc_timestamp("scraped_at", F.current_timezone())
    fraction = F.when(F.date_format(utc, "SSSSSS") != "000000", F.date_format(utc, ".SSSSSS"))
    texts = {
        "remote": F.initcap(F.col("remote").cast("string")),
        "skills": F.array_join("skills", "; "),
        "posted_date": F.date_format("posted_date", "yyyy-MM-dd"),
        "scraped_at": F.concat(
            F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce(fraction, F.lit("")), F.lit("+00:00")
        ),
    }
    return records.select(*[texts.get(c, F.col(c)).alias(c) for c in V.CSV_COLUMNS])


def append_csv(records: DataFrame, path: str) -> None:
    """Append to a CSV folder; each part file starts with the header, nulls are empty."""
    writer = csv_rows(records).write.mode("append").option("header", True)
    writer.option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


@dataclass(frozen=True)
class Base:
    """A stored state of the job table: all runs up to ``version``."""

    seq: int
    version: int
    rows: int
    buckets: int
    chunks: int


@dataclass(frozen=True)
class JobStore:
    spark: SparkSession
    root: str

    def _path(self, table: str, run_id: int | None = None) -> str:
        return f"{self.root}/{table}" if run_id is None else f"{self.root}/{table}/run_id={run_id}"

    def _write(self, df: DataFrame, table: str, run_id: int) -> None:
        rows = df.drop("run_id") if "run_id" in df.columns else df
        rows.write.mode("overwrite").parquet(self._path(table, run_id))

    # --- reading ---------------------------------------------------------------------------

    def observations(self) -> DataFrame:
        return read_table(self.spark, self._path("observations"), OBSERVATION)

    def first_records(self) -> DataFrame:
        """Jobs as first seen, without ``last_seen``."""
        return read_table(self.spark, self._path("jobs"), OBSERVATION)

    def jobs(self) -> DataFrame:
        """The job table: frozen attributes, ``first_seen`` and ``last_seen``."""
        return self._jobs_since(self.base())

    def _jobs_since(self, base: Base | None, until: int | None = None) -> DataFrame:
        """The base and the runs after it, up to a run if given."""
        after = F.lit(True) if base is None else F.col("run_id") > base.version
        after &= F.lit(True) if until is None else F.col("run_id") <= until
        first = self.first_records().filter(after).withColumnRenamed("scraped_at", "first_seen")
        last = self.observations().filter(after).groupBy("job_id").agg(F.max_by("scraped_at", "run_id").alias("_seen"))
        if base is None:
            return first.join(last.withColumnRenamed("_seen", "last_seen"), "job_id", "left")
        stored = self.base_rows(base).drop("bucket").unionByName(first, allowMissingColumns=True)
        # Small runs since the base are broadcast by Spark; the base then needs no shuffle.
        return stored.join(last, "job_id", "left").withColumn("last_seen", F.coalesce("_seen", "last_seen")).select(
            "job_id", *[c for c in stored.columns if c != "job_id"])

    def job_skills(self) -> DataFrame:
        return explode_skills(self.first_records(), "run_id").distinct()

    def skill_snapshots(self) -> DataFrame:
        return read_table(self.spark, self._path("skill_snapshots"), SKILL_SNAPSHOT)

    def market_snapshots(self) -> DataFrame:
        return read_table(self.spark, self._path("market_snapshots"), MARKET_SNAPSHOT)

    def quarantine(self) -> DataFrame:
        return read_table(self.spark, self._path("quarantine"), _QUARANTINE)

    def alerts(self) -> DataFrame:
        return read_table(self.spark, self._path("alerts"), _ALERT)

    def alert_digest(self, limit: int = V.DIGEST_ITEMS) -> DataFrame:
        return digest_of(self.alerts(), limit)

    def runs(self) -> DataFrame:
        return latest_runs(read_table(self.spark, self._path("runs"), _RUN_LOG)).drop("origin")

    # --- run log ---------------------------------------------------------------------------

    def start_run(self, started_at: datetime | None = None, origin: str | None = None) -> int:
        """A run id that no other run has or gets; an origin seen before finds its own run id again."""
        log = read_table(self.spark, self._path("runs"), _RUN_LOG)
        run_id = origin and log.filter(F.col("origin") == origin).agg(F.max("run_id")).first()[0]
        if not run_id:
            run_id = self._claim((log.agg(F.max("run_id")).first()[0] or 0) + 1)
        self._log(run_id, started_at or _now(), None, "running", 0, 0, 0, None, 0, origin)
        return run_id

    def _claim(self, number: int, folder: str = "claims") -> int:
        """The first free number from ``number`` on. Creating the claim fails for all writers but one.

        Runs stored under a number that nobody claimed are passed over.
        """
        while True:
            system, location = _location(self.spark, f"{self._path(folder)}/{number}")
            taken = folder == "claims" and system.exists(_location(self.spark, self._path("observations", number))[1])
            if not taken and system.createNewFile(location):
                return number
            number += 1

    def finish_run(self, run_id: int, started_at: datetime, status: str, fetched: int, new: int,
                   invalid: int, errors: Sequence[str] = (), finished_at: datetime | None = None,
                   origin: str | None = None) -> None:
        text = "; ".join(errors) if errors else None
        self._log(run_id, started_at, finished_at or _now(), status, fetched, new, invalid, text, 1, origin)

    def _log(self, *row) -> None:
        self.spark.createDataFrame([row], _RUN_LOG).write.mode("append").parquet(self._path("runs"))

    # --- bases -----------------------------------------------------------------------------

    def _base_log(self) -> DataFrame:
        return read_table(self.spark, self._path("bases_log"), _BASE_LOG)

    def _log_base(self, *row) -> None:
        self.spark.createDataFrame([row], _BASE_LOG).coalesce(1).write.mode("append").parquet(self._path("bases_log"))

    def _next_number(self) -> int:
        return self._claim(1 + (self._base_log().agg(F.max("seq")).first()[0] or 0), "bases_claims")

    def base(self, until: int | None = None) -> Base | None:
        """The newest base (that covers no run after ``until``) of whose runs none was written since it was begun."""
        log = self._base_log()
        written = log.filter("run_id IS NOT NULL").select(F.col("seq").alias("_seq"), F.col("run_id").alias("_run"))
        bases = log.filter("version IS NOT NULL")
        if until is not None:
            bases = bases.filter(F.col("version") <= until)
        valid = bases.join(written, (F.col("_seq") > F.col("seq")) & (F.col("_run") <= F.col("version")), "left_anti")
        best = valid.orderBy(F.desc("version"), F.desc("seq")).first()
        return best and Base(best.seq, best.version, best.rows, best.buckets, best.chunks)

    def base_rows(self, base: Base) -> DataFrame:
        return self.spark.read.schema(_BASE).parquet(f"{self._path('bases')}/seq={base.seq}")

    def base_index(self, base: Base) -> DataFrame:
        return self.spark.read.schema(_BASE_INDEX).parquet(f"{self._path('base_index')}/seq={base.seq}")

    def fold(self) -> Base | None:
        """Write the job table as of the newest stored run as a new base; older bases stay for whoever reads them.

        The base counts from its log row on, which is written last. Its number is claimed first: a run
        that ends while the base is being written has a larger one, which voids the base if it covers the run.
        """
        seq, last = self._next_number(), self.base()
        since = F.lit(True) if last is None else F.col("run_id") > last.version
        version = self.observations().filter(since).agg(F.max("run_id")).first()[0]
        if version is None:
            return last
        rows = (last.rows if last else 0) + self.first_records().filter(since & (F.col("run_id") <= version)).count()
        buckets = max(1, -(-rows // BUCKET_ROWS))
        base = Base(seq, version, rows, buckets, chunks_for(rows, buckets))
        table = self._jobs_since(last, version).withColumn("bucket", bucket_of(F.col("job_id"), buckets))
        # A bucket in several parts, so that no task holds a whole one, or those that hash to the same task.
        part = F.pmod(F.xxhash64("job_id", F.lit("part")), F.lit(BUCKET_PARTS))
        dealt = table.repartition("bucket", part).sortWithinPartitions("bucket", "job_id")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self._path('bases')}/seq={seq}")
        index = build_index(self.base_rows(base), buckets, base.chunks)
        index.write.mode("overwrite").parquet(f"{self._path('base_index')}/seq={seq}")
        self._log_base(seq, version, None, rows, buckets, base.chunks)
        return base

    def fold_if_due(self) -> Base | None:
        """A new base once the runs since the last one are large enough beside it."""
        base = self.base()
        since = self.runs() if base is None else self.runs().filter(F.col("run_id") > base.version)
        grown = since.agg(F.sum("records_fetched")).first()[0] or 0
        return self.fold() if grown >= max(FOLD_ROWS, FOLD_SHARE * (base.rows if base else 0)) else base

    # --- writing ---------------------------------------------------------------------------

    def save_records(self, valid: DataFrame, run_id: int) -> DataFrame:
        """Store a batch, the first row of each job_id, and return the jobs new to the table.

        Of the base only the buckets that may hold an id of the batch are read, by its skip index.
        """
        columns = [f.name for f in OBSERVATION.fields if f.name != "run_id"]
        # Cleaning and tagging happen in this write.
        with finer_tasks(self.spark):
            self._write(keep_first(valid.select(*columns)), "observations", run_id)
        batch = self.observations().filter(F.col("run_id") == run_id)
        base = self.base(run_id - 1)
        others = self.first_records().filter(F.col("run_id") != run_id)
        if base is None:
            new = new_records(batch, others)
        else:
            old = known_among(batch, self.base_rows(base), self.base_index(base), base.buckets, base.chunks)
            recent = others.filter(F.col("run_id") > base.version)
            new = new_records(batch, recent).join(old, "job_id", "left_anti")
        self._write(new, "jobs", run_id)
        self._log_base(self._next_number(), None, run_id, None, None, None)
        return self.first_records().filter(F.col("run_id") == run_id)

    def save_quarantine(self, broken: DataFrame, run_id: int) -> None:
        columns = [f.name for f in _QUARANTINE.fields if f.name != "run_id"]
        self._write(broken.select(*columns), "quarantine", run_id)

    def snapshot(self, run_id: int, snapshot_date: date | None = None) -> None:
        """Counts of all jobs first seen up to this run: the last snapshot before plus what came since.

        Snapshots of later runs, which a repeated run may have changed, are taken again.
        """
        day = snapshot_date or _now().date()
        taken = self.market_snapshots().select("run_id", "snapshot_date").distinct()
        later = taken.filter(F.col("run_id") > run_id).orderBy("run_id").collect()
        for number, when in [(run_id, day), *((r.run_id, r.snapshot_date) for r in later)]:
            self._snapshot(number, when)

    def _snapshot(self, run_id: int, snapshot_date: date) -> None:
        day = F.lit(snapshot_date.isoformat()).cast("date")
        market = self.market_snapshots().filter(F.col("run_id") < run_id)
        before = market.agg(F.max("run_id")).first()[0]
        since = F.col("run_id") <= run_id if before is None else F.col("run_id").between(before + 1, run_id)
        new = self.first_records().filter(since)
        gained = explode_skills(new, "run_id").distinct().groupBy("skill").agg(F.count(F.lit(1)).alias("job_count"))
        totals = new.agg(*market_totals())
        if before is not None:
            old = self.skill_snapshots().filter(F.col("run_id") == before).select("skill", "job_count")
            gained = old.unionByName(gained).groupBy("skill").agg(F.sum("job_count").alias("job_count"))
            totals = market.filter(F.col("run_id") == before).select(*_TOTALS).unionByName(totals).agg(
                *[F.sum(t).alias(t) for t in _TOTALS])
        self._write(gained.select(day.alias("snapshot_date"), "skill", "job_count"), "skill_snapshots", run_id)
        labelled = totals.withColumns({"run_id": F.lit(run_id).cast("long"), "snapshot_date": day})
        self._write(with_average(labelled), "market_snapshots", run_id)

    def save_alerts(self, run_id: int, keywords: Sequence[str] = V.ALERT_KEYWORDS,
                    min_new: int = V.MIN_NEW_RECORDS, enabled: bool = True) -> DataFrame:
        """Store every matching new job of the run, if the run sends an alert."""
        new = self.first_records().filter(F.col("run_id") == run_id)
        columns = [f.name for f in _ALERT.fields]
        self._write(stored_alerts(new, keywords, min_new, enabled).select(*columns), "alerts", run_id)
        return self.alerts().filter(F.col("run_id") == run_id)


_TOTALS = ["total_jobs", "remote_jobs", "salary_total", "paid_jobs"]


def _now() -> datetime:
    return datetime.now(timezone.utc)
