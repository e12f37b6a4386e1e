"""One run from landed sources to stored, snapshotted and alerted jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.skills import Taxonomy
from hirelens.operators.clean import check, clean, keep_first, violations
from hirelens.operators.enrich import enrich
from hirelens.plans.store import JobStore, append_csv
from hirelens.schemas import RAW_POSTING
from hirelens.sources.comments import damaged_lines, hiring_threads, parse_comments_counted, read_hits, top_level_comments
from hirelens.sources.listing import parse_listing, read_pages

@dataclass
class Counted:
    """Rows of a source with counters that are there once the rows have been landed."""

    rows: DataFrame
    counters: list[Observation]


Reader = Callable[[SparkSession, Mapping[str, str]], DataFrame | Counted]


def _listing_reader(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    pages = read_pages(spark, options["pages"])
    base = F.lit(options["base_url"]) if "base_url" in options else None
    return parse_listing(pages, base_url=base)


def _comment_reader(spark: SparkSession, options: Mapping[str, str]) -> Counted:
    """Comments newest first, as the feed gives them."""
    comments = read_hits(spark, options["comments"]).withColumn("ordinal", -F.col("objectID").try_cast("long"))
    threads = read_hits(spark, options["threads"], "thread")
    newest = threads.withColumn("ordinal", -F.coalesce(F.col("objectID").try_cast("long"), F.lit(0)))
    chosen = hiring_threads(newest, int(options.get("limit", "1")))
    return Counted(*parse_comments_counted(top_level_comments(comments, chosen)))


# Add a source by adding its reader.
READERS: dict[str, Reader] = {V.LISTING_SOURCE: _listing_reader, V.COMMENT_SOURCE: _comment_reader}

# Room for the ordinals of one source, positive or negative; sources keep their order in the combined input.
# A source that needs more is reported as broken rather than mixed into its neighbours.
SOURCE_STRIDE = 10**16


def _within_stride(ordinal: Column) -> Column:
    wide = F.concat(F.lit("ordinal beyond 10^16: "), ordinal.cast("string"))
    return F.when(F.abs(ordinal) >= SOURCE_STRIDE, F.raise_error(wide).cast("long")).otherwise(ordinal)


@dataclass
class RunStats:
    run_id: int = 0
    fetched: int = 0
    unique: int = 0
    with_skills: int = 0
    valid: int = 0
    invalid: int = 0
    new: int = 0
    errors: list[str] = field(default_factory=list)
    status: str = "running"
    # Counters of the sources that have any, by source.
    sources: dict[str, dict[str, int]] = field(default_factory=dict)


def collect(spark: SparkSession, active: Sequence[str], options: Mapping[str, Mapping[str, str]], landing: str,
            readers: Mapping[str, Reader] = READERS, counters: dict[str, dict[str, int]] | None = None,
            ) -> tuple[DataFrame, list[str]]:
    """Land every active source and return their union; a failing source is reported, not fatal.

    Reads are lazy, so each source is written to the landing folder: that write is where a
    broken source fails, and where its counters come from, which are put into ``counters``.
    """
    frames: list[DataFrame] = []
    errors: list[str] = []
    names = [f.name for f in RAW_POSTING.fields]
    for place, name in enumerate(active):
        if name not in readers:
            errors.append(f"{name}: unknown source")
            continue
        try:
            read = readers[name](spark, options.get(name, {}))
            rows, watched = (read.rows, read.counters) if isinstance(read, Counted) else (read, [])
            damaged = sum(damaged_lines(spark, options[name][k]) for k in ("comments", "threads") if k in options.get(name, {}))
            if damaged:
                errors.append(f"{name}: {damaged} damaged lines")
            own = _within_stride(F.coalesce("ordinal", F.lit(0)))
            shifted = (own + F.lit((2 * place + 1) * SOURCE_STRIDE)).alias("ordinal")
            path = f"{landing}/{name}"
            rows.select(shifted, *names[1:]).write.mode("overwrite").parquet(path)
            frames.append(spark.read.schema(RAW_POSTING).parquet(path))
            if counters is not None and watched:
                counters[name] = {k: v for observation in watched for k, v in observation.get.items()}
        except Exception as failure:  # noqa: BLE001 - one source must not stop the others
            errors.append(f"{name}: {str(failure).splitlines()[0] if str(failure) else type(failure).__name__}")
    if not frames:
        return spark.createDataFrame([], RAW_POSTING), errors
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), errors


@dataclass
class Processed:
    valid: DataFrame
    quarantine: DataFrame
    counters: list[Observation]

    def counts(self) -> dict[str, int]:
        """Counters of the stages; available after an action on ``valid``."""
        merged: dict[str, int] = {}
        for observation in self.counters:
            merged.update(observation.get)
        return merged


def process_raw(raw: DataFrame, scraped_at: Column | None = None, taxonomy: Taxonomy = V.TAXONOMY,
                fuzzy: bool = True, threshold: int = V.FUZZY_THRESHOLD,
                gazetteer: DataFrame | None = None) -> Processed:
    """Clean, de-duplicate, enrich, validate. The counters ride along, without extra passes."""
    seen, kept, judged = Observation(), Observation(), Observation()
    unique = keep_first(clean(raw.observe(seen, F.count(F.lit(1)).alias("fetched")), scraped_at))
    rich = enrich(unique, taxonomy, fuzzy, threshold, gazetteer).observe(
        kept, F.count(F.lit(1)).alias("unique"), F.count_if(F.size("skills") > 0).alias("with_skills")
    )
    broken = F.size("violations") > 0
    checked = check(rich).observe(
        judged, F.count_if(~broken).alias("valid"), F.count_if(broken).alias("invalid")
    )
    bad = rich.withColumn("violations", violations(rich.columns)).filter(broken)
    return Processed(checked.filter(~broken).drop("violations"), bad, [seen, kept, judged])


def store_run(store: JobStore, raw: DataFrame, stats: RunStats, started: datetime, scraped_at: Column,
              keywords: Sequence[str] = V.ALERT_KEYWORDS, csv_path: str | None = None,
              taxonomy: Taxonomy = V.TAXONOMY, origin: str | None = None) -> RunStats:
    """Process, store, snapshot, alert, and close the started run in the log. Batch and stream share it."""
    def close() -> None:
        store.finish_run(stats.run_id, started, stats.status, stats.fetched, stats.new, stats.invalid, stats.errors, origin=origin)

    try:
        done = process_raw(raw, scraped_at, taxonomy)
        new = store.save_records(done.valid, stats.run_id)
        for name, value in done.counts().items():
            setattr(stats, name, value)
        stats.new = new.count()
        if stats.invalid:
            store.save_quarantine(done.quarantine, stats.run_id)
        if csv_path and stats.new:
            append_csv(new, csv_path)
        store.snapshot(stats.run_id, started.date())
        if stats.new:
            store.save_alerts(stats.run_id, keywords)
        store.fold_if_due()
        stats.status = "success" if not stats.errors else "partial" if stats.fetched else "failed"
    except Exception as crash:
        stats.errors.append(f"run: {crash}")
        stats.status = "failed"
        close()
        raise
    close()
    return stats


def run_once(spark: SparkSession, root: str, active: Sequence[str], options: Mapping[str, Mapping[str, str]],
             keywords: Sequence[str] = V.ALERT_KEYWORDS, started: datetime | None = None,
             csv_path: str | None = None, readers: Mapping[str, Reader] = READERS,
             taxonomy: Taxonomy = V.TAXONOMY) -> RunStats:
    """Collect all sources and store them as one run."""
    store = JobStore(spark, root)
    started = started or datetime.now(timezone.utc)
    stats = RunStats(run_id=store.start_run(started))
    raw, stats.errors = collect(spark, active, options, f"{root}/landing/run_id={stats.run_id}", readers, stats.sources)
    return store_run(store, raw, stats, started, F.lit(started).cast("timestamp"), keywords, csv_path, taxonomy)
