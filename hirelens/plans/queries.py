"""Every operator as a query over the tables of a folder: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import dates, flags, html, salary, skills, text
from hirelens.operators import alerts, analytics, clean, enrich, filters, history, known_ids, near_names, trigrams
from hirelens.plans import batch
from hirelens.plans.store import JobStore, append_csv
from hirelens.session import shared_dir
from hirelens.sources import bridge, comments, listing, tables
from hirelens.streaming import flows, metrics, weeks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2026-01-01 00:00:00"
ALERT_WORDS = ["customer#00000001", "brand#13", "remote"]
PAGE_SELECTORS = {
    "card": ["section.listing", "body"],
    "title": ["h2.title", "h1"],
    "company": ["h3.company", "nav li"],
    "location": ["p.location", "div.ad"],
    "posted": ["time"],
    "link": ["footer a.apply", "nav a"],
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _money(*names: str) -> list[Column]:
    return [F.round(n, 4).alias(n) for n in names]


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


# --- inputs --------------------------------------------------------------------------------


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared jobs without skills."""
    return filters.prepare_jobs(bridge.view(spark, sf, "jobs"))


def _full_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs with title, url and the skills array."""
    jobs = bridge.view(spark, sf, "jobs")
    per_job = bridge.view(spark, sf, "job_skills").groupBy("job_id").agg(
        F.sort_array(F.collect_set("skill")).alias("skills")
    )
    named = jobs.join(per_job, "job_id", "left").withColumns(
        {
            "title": F.concat_ws(" ", F.lower("source"), F.lit("role"), F.col("job_id")),
            "url": F.concat(F.lit("https://example.com/jobs/"), F.col("job_id")),
            "description": F.lit(None).cast("string"),
            "skills": F.coalesce("skills", F.array().cast("array<string>")),
        }
    )
    return named


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.view(spark, sf, "raw_postings")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return tables.spread_scan(bridge.table(spark, sf, "pages"))


def _scraped() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _unique(spark: SparkSession, sf: str) -> DataFrame:
    return clean.keep_first(clean.clean(_raw(spark, sf), _scraped()))


def _runs(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("run_id").agg(F.max("first_seen").alias("snapshot_date"))


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One run per day of events: a row when it starts, and one when it ends unless it is a Sunday."""
    events = bridge.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    days = events.groupBy("day").agg(
        F.datediff("day", F.lit("2023-12-31").cast("date")).cast("long").alias("run_id"),
        F.min("ts").cast("timestamp").alias("started_at"),
        F.max("ts").cast("timestamp").alias("finished_at"),
        F.count(F.lit(1)).alias("records_fetched"),
        F.count_if(F.col("event_type") == "signup").alias("records_new"),
        F.count_if(F.col("event_type") == "error").alias("records_invalid"),
    )
    none = F.lit(None)
    started = days.select(
        "run_id", "started_at", none.cast("timestamp").alias("finished_at"), F.lit("running").alias("status"),
        *[F.lit(0).cast("long").alias(c) for c in ("records_fetched", "records_new", "records_invalid")],
        none.cast("string").alias("errors"), F.lit(0).alias("seq"),
    )
    has_errors = F.col("records_invalid") > F.col("records_new")
    ended = days.filter(F.dayofweek("day") != 1).select(
        "run_id", "started_at", "finished_at",
        history.run_status(has_errors, F.col("records_fetched")).alias("status"),
        "records_fetched", "records_new", "records_invalid",
        F.when(has_errors, F.concat_ws("; ", F.lit("more errors"), F.lit("than new"))).alias("errors"),
        F.lit(1).alias("seq"),
    )
    return history.latest_runs(started.unionByName(ended))


# --- market analytics ------------------------------------------------------------------------


@query
def top_skills(spark, sf):
    return analytics.top_values(bridge.view(spark, sf, "job_skills"), "skill", 15)


@query
def skill_rows(spark, sf):
    return analytics.explode_skills(_full_jobs(spark, sf), "source")


@query
def skill_list_from_text(spark, sf):
    joined = _full_jobs(spark, sf).select("job_id", F.array_join("skills", ", ").alias("t"))
    listed = joined.select("job_id", text.split_list(F.col("t")).alias("skills"))
    return listed.select("job_id", F.size("skills").cast("long").alias("n"), F.array_join("skills", "|").alias("skills"))


@query
def top_companies(spark, sf):
    return analytics.top_values(_jobs(spark, sf), "company", 10)


@query
def top_locations(spark, sf):
    return analytics.top_values(_jobs(spark, sf), "location", 10)


@query
def work_mode(spark, sf):
    return analytics.work_mode(_jobs(spark, sf))


@query
def jobs_by_seniority(spark, sf):
    return analytics.value_counts(_jobs(spark, sf), "seniority")


@query
def weekly_postings(spark, sf):
    return analytics.weekly_postings(_jobs(spark, sf)).select(_text("week"), "jobs")


@query
def kpis(spark, sf):
    jobs = _jobs(spark, sf).withColumns(
        {"first_seen": F.col("first_seen").cast("timestamp"), "last_seen": F.col("first_seen").cast("timestamp")}
    )
    as_of = jobs.agg(F.max("first_seen")).scalar()
    out = analytics.kpis(jobs, as_of, _run_log(spark, sf))
    return out.select(
        "total_jobs", "new_today", *_money("remote_share", "median_salary"),
        "remote_text", "median_text", "update_text",
    )


@query
def currency_freq(spark, sf):
    return analytics.currencies(_jobs(spark, sf))


def _main_slice(jobs: DataFrame) -> DataFrame:
    return filters.currency_slice(jobs, analytics.main_currency(jobs))


@query
def salary_hist(spark, sf):
    bins = analytics.salary_histogram(_main_slice(_jobs(spark, sf)))
    return bins.select(F.col("bin").cast("long").alias("bin"), *_money("from_salary", "to_salary"), "jobs")


@query
def salary_box(spark, sf):
    box = analytics.salary_box(_main_slice(_jobs(spark, sf)))
    return box.select(
        "seniority", *_money("q1", "median", "q3", "low_whisker", "high_whisker"), "outliers", "jobs"
    )


@query
def salary_by_skill(spark, sf):
    paid = _main_slice(_jobs(spark, sf)).select("job_id", "salary_mid")
    rows = bridge.view(spark, sf, "job_skills").join(paid, "job_id").select("skill", "salary_mid")
    return analytics.salary_by_skill(rows).select("skill", *_money("median_salary"), "jobs")


@query
def skill_cooccurrence(spark, sf):
    return analytics.skill_cooccurrence(bridge.view(spark, sf, "job_skills"))


@query
def skill_cooccurrence_matrix(spark, sf):
    return analytics.cooccurrence_matrix(analytics.skill_cooccurrence(bridge.view(spark, sf, "job_skills")))


@query
def filter_jobs(spark, sf):
    jobs = filters.prepare_jobs(_full_jobs(spark, sf))
    kept = filters.filter_jobs(
        jobs,
        sources=["BUILDING", "MACHINERY", "HOUSEHOLD"],
        seniorities=["1-URGENT", "2-HIGH", V.DEFAULT_SENIORITY],
        work_mode="onsite",
        any_skills=["Brand#13", "Brand#22", "Brand#55"],
        posted_between=("1996-01-01", "1999-06-30"),
    )
    return kept.select("job_id", "source", "seniority", _text("posted_date"), F.array_join("skills", ", ").alias("skills"))


@query
def search_jobs(spark, sf):
    jobs = filters.prepare_jobs(_full_jobs(spark, sf))
    return filters.filter_jobs(jobs, query="  NATION_1 Brand#2").select("job_id", "title", "company", "location")


@query
def search_jobs_indexed(spark, sf):
    """The same search through a stored trigram index over all jobs."""
    jobs = filters.prepare_jobs(_full_jobs(spark, sf))
    index = trigrams.TrigramIndex.build(jobs, "job_id", filters.search_text(), shared_dir(spark, "trigrams"))
    return index.search(jobs, filters.search_text(), "NATION_1 Brand#2").select("job_id", "title", "company", "location")


@query
def filter_domains(spark, sf):
    return filters.filter_domains(_jobs(spark, sf), bridge.view(spark, sf, "job_skills"))


@query
def explorer(spark, sf):
    table = analytics.explorer(filters.prepare_jobs(_full_jobs(spark, sf)))
    return table.withColumn("posted", _text("posted"))


@query
def any_from_source(spark, sf):
    return analytics.any_from_source(bridge.view(spark, sf, "jobs"), "BUILDING")


# --- incremental tables ----------------------------------------------------------------------


@query
def jobs_upsert(spark, sf):
    folded = history.fold_jobs(bridge.view(spark, sf, "observations"), ["title", "salary_min"], seen="seen_on")
    return folded.select("job_id", "title", "salary_min", "run_id", _text("first_seen"), _text("last_seen"))


@query
def jobs_upsert_step(spark, sf):
    """The same table reached by adding the newest run to the state before it."""
    seen = bridge.view(spark, sf, "observations")
    newest = seen.agg(F.max("run_id")).scalar()
    before = history.fold_jobs(seen.filter(F.col("run_id") < newest), ["title", "salary_min"], seen="seen_on")
    step = clean.keep_first(seen.filter(F.col("run_id") == newest))
    after = history.upsert(before, step, seen="seen_on")
    return after.select("job_id", "title", "salary_min", "run_id", _text("first_seen"), _text("last_seen"))


@query
def new_jobs_per_run(spark, sf):
    return history.sightings_per_run(bridge.view(spark, sf, "observations"))


@query
def newest_run_records(spark, sf):
    seen = bridge.view(spark, sf, "observations")
    newest = seen.agg(F.max("run_id")).scalar()
    known = seen.filter(F.col("run_id") < newest).select("job_id").distinct()
    step = clean.keep_first(seen.filter(F.col("run_id") == newest))
    new = history.new_records(step, known).select("job_id", F.lit("new").alias("kind"), "title")
    return new.unionByName(history.known_records(step, known).select("job_id", F.lit("known").alias("kind"), "title"))


@query
def newest_run_indexed(spark, sf):
    """The same records, found through the skip index over the ids of all earlier runs."""
    seen = bridge.view(spark, sf, "observations")
    newest = seen.agg(F.max("run_id")).scalar()
    path = shared_dir(spark, "known-ids")
    ids = seen.filter(F.col("run_id") < newest).select("job_id").distinct()
    buckets, step = 16, clean.keep_first(seen.filter(F.col("run_id") == newest))
    ids.withColumn("bucket", known_ids.bucket_of(F.col("job_id"), buckets)).repartition(buckets, "bucket").write.partitionBy(
        "bucket").parquet(f"{path}/ids")
    known = spark.read.schema("job_id string, bucket int").parquet(f"{path}/ids")
    chunks = known_ids.chunks_for(known.count(), buckets)
    known_ids.build_index(known, buckets, chunks).write.parquet(f"{path}/index")
    old = known_ids.known_among(step, known, spark.read.parquet(f"{path}/index"), buckets, chunks)
    new = step.join(old, "job_id", "left_anti").select("job_id", F.lit("new").alias("kind"), "title")
    return new.unionByName(step.join(old, "job_id", "left_semi").select("job_id", F.lit("known").alias("kind"), "title"))


def _snapshots(spark, sf):
    jobs = bridge.view(spark, sf, "jobs")
    runs = _runs(jobs)
    return (
        history.skill_snapshots(jobs, bridge.view(spark, sf, "job_skills"), runs),
        history.market_snapshots(jobs, runs),
    )


@query
def skill_snapshots(spark, sf):
    return _snapshots(spark, sf)[0].select("run_id", _text("snapshot_date"), "skill", "job_count")


@query
def market_snapshots(spark, sf):
    return _snapshots(spark, sf)[1].select(
        "run_id", _text("snapshot_date"), "total_jobs", "remote_jobs", *_money("avg_salary")
    )


@query
def market_by_currency(spark, sf):
    return history.market_by_currency(bridge.view(spark, sf, "jobs")).select(
        "salary_currency", "paid_jobs", *_money("avg_salary")
    )


@query
def skill_trend(spark, sf):
    trend = analytics.skill_trend(*_snapshots(spark, sf))
    return trend.select("run_id", "skill", "job_count", "total_jobs", *_money("share"))


@query
def latest_run_top(spark, sf):
    top = analytics.latest_top(analytics.skill_trend(*_snapshots(spark, sf)))
    return top.select("run_id", "skill", *_money("share"))


@query
def trend_of_leaders(spark, sf):
    """The trend is written once; the newest run, its leaders and their lines are read from it."""
    path = shared_dir(spark, "trend")
    analytics.skill_trend(*_snapshots(spark, sf)).write.parquet(path)
    trend = analytics.trend_of(spark.read.parquet(path))
    return trend.select("run_id", "skill", *_money("share"))


@query
def has_trend(spark, sf):
    return analytics.has_trend(_snapshots(spark, sf)[1])


@query
def run_log(spark, sf):
    log = _run_log(spark, sf)
    return log.select(
        "run_id", "status", "records_fetched", "records_new", "records_invalid", "errors",
        (F.unix_micros("finished_at") - F.unix_micros("started_at")).alias("duration_us"),
        history.run_outcome(F.col("errors").isNotNull(), F.col("records_fetched")).alias("outcome"),
    )


@query
def new_by_status(spark, sf):
    return history.new_by_status(_run_log(spark, sf))


# --- cleaning --------------------------------------------------------------------------------


@query
def normalize_text(spark, sf):
    return _raw(spark, sf).select(
        "ordinal", *[text.normalize_text(F.col(c)).alias(c) for c in ("title", "company", "description")]
    )


@query
def normalize_documents(spark, sf):
    docs = tables.spread_scan(bridge.table(spark, sf, "documents")).select("doc_id", text.normalize_text(F.col("text")).alias("t"))
    return docs.select("doc_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("digest"))


@query
def normalize_location(spark, sf):
    return _raw(spark, sf).select("ordinal", text.normalize_location(F.col("location")).alias("location"))


@query
def normalize_url(spark, sf):
    return _raw(spark, sf).select("ordinal", text.normalize_url(F.col("url")).alias("url"))


@query
def parse_dates(spark, sf):
    parsed = dates.parse_date(F.col("posted")).cast("string").alias("posted_date")
    return _raw(spark, sf).select("ordinal", "posted", parsed)


@query
def truncate_titles(spark, sf):
    docs = tables.spread_scan(bridge.table(spark, sf, "documents"))
    plain = docs.select("doc_id", text.normalize_text(F.col("text")).alias("t"))
    return plain.select("doc_id", text.truncate(F.col("t"), 60).alias("title"))


@query
def job_ids(spark, sf):
    return clean.clean(_raw(spark, sf), _scraped()).select("ordinal", "job_id")


@query
def clean_dedup(spark, sf):
    return _unique(spark, sf).select(
        "ordinal", "job_id", "source", "title", "company", "location", _text("posted_date"), "url", "description"
    )


def _records(spark, sf):
    """Records as another source might deliver them: salaries as text, gaps everywhere."""
    return _raw(spark, sf).select(
        "ordinal",
        F.md5(F.col("ordinal").cast("string")).alias("job_id"),
        "source",
        "title",
        F.when(F.col("ordinal") % 31 != 0, F.col("ordinal") % 2 == 0).alias("remote"),
        F.when(F.col("ordinal") % 5 == 0, F.col("posted"))
        .otherwise((F.col("ordinal") % 9 - 3).cast("string")).alias("salary_min"),
        F.lit("90000").alias("salary_max"),
        F.when(F.col("ordinal") % 37 != 0, _scraped()).alias("scraped_at"),
    )


@query
def dq_violations(spark, sf):
    checked = clean.check(_records(spark, sf))
    return checked.select(
        "ordinal", "title", F.col("salary_min").cast("double").alias("salary_min"),
        F.array_join("violations", ",").alias("violations"),
    )


@query
def dq_counts(spark, sf):
    broken = clean.check(_records(spark, sf)).select(F.explode("violations").alias("rule"))
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("records"))


@query
def source_union(spark, sf):
    """All sources as one input, in source order."""
    listed = listing.parse_listing(_pages(spark, sf), PAGE_SELECTORS)
    feed = comments.parse_comments(_feed(spark, sf))
    other = _raw(spark, sf)
    union = listed.unionByName(feed, allowMissingColumns=True).unionByName(other, allowMissingColumns=True)
    return union.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count("location").alias("located"))


# --- enrichment ------------------------------------------------------------------------------


def _land_feed(spark, sf, path):
    """The postings as a comment feed in JSON lines; after every fiftieth a line that breaks off, some comments no posting."""
    chat = F.when(F.col("ordinal") % 9 == 0, F.lit("Any news?")).otherwise(F.col("comment_text"))
    hit = F.struct("objectID", F.lit("1").alias("parent_id"), "created_at", chat.alias("comment_text"))
    line = F.to_json(F.struct(F.array(hit).alias("hits"), F.lit(1).alias("nbPages")))
    feed = _feed(spark, sf).select(F.explode(F.when(F.col("ordinal") % 50 == 0, F.array(line, F.left(line, F.lit(25)))).otherwise(
        F.array(line))).alias("value"))
    feed.write.text(f"{path}/comments")
    thread = F.to_json(F.struct(F.array(F.struct(F.lit("1").alias("objectID"), F.lit("Ask HN: Who is hiring?").alias("title"))).alias("hits")))
    spark.range(1).select(thread.alias("value")).write.text(f"{path}/threads")


@query
def collect_sources(spark, sf):
    """Five sources in one run, two of them out of order: rows by source, counters, and what went wrong."""
    path = shared_dir(spark, "sources")
    _land_feed(spark, sf, path)

    def broken(spark, options):
        return _raw(spark, sf).withColumn("title", F.raise_error(F.lit("feed is down")))

    def table(spark, options):
        return _raw(spark, sf).filter(F.col("source") == options["source"])

    def cards(spark, options):
        return listing.parse_listing(listing.read_pages(spark, options["pages"]), PAGE_SELECTORS)

    readers = {**batch.READERS, "broken": broken, "table": table, "cards": cards}
    options = {V.COMMENT_SOURCE: {"comments": f"{path}/comments", "threads": f"{path}/threads"},
               "table": {"source": "src2"}, "cards": {"pages": f"{sf}/pages.parquet"}}
    counters: dict[str, dict[str, int]] = {}
    active = [V.COMMENT_SOURCE, "broken", "table", "nowhere", "cards"]
    rows, errors = batch.collect(spark, active, options, f"{path}/landing", readers, counters)
    # "source: what went wrong", for damaged lines with their number.
    told = [("error", e.split(":")[0], int(e.split(": ")[1].split(" ")[0]) if e.endswith("damaged lines") else 1) for e in errors]
    told += [(kind, name, n) for name, found in counters.items() for kind, n in found.items()]
    return rows.groupBy(F.lit("rows").alias("kind"), "source").agg(F.count(F.lit(1)).alias("n")).unionByName(
        spark.createDataFrame(told, "kind string, source string, n long"))


@query
def run_counters(spark, sf):
    """Counters of the second of two runs, the first of which had the postings of one source."""
    store, raw = JobStore(spark, shared_dir(spark, "counters")), _raw(spark, sf)
    started = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for part in (raw.filter("source = 'src1'"), raw):
        stats = batch.RunStats(run_id=store.start_run(started))
        batch.store_run(store, part, stats, started, _scraped())
    names = ["fetched", "unique", "with_skills", "valid", "invalid", "new"]
    return spark.createDataFrame([(n, getattr(stats, n)) for n in names], "counter string, n long")


@query
def salary_extract(spark, sf):
    found = _raw(spark, sf).select("ordinal", salary.extract_salary(F.col("description")).alias("s"))
    return found.select("ordinal", "s.low", "s.high", "s.currency")


@query
def remote_flag(spark, sf):
    scope = flags.remote_scope(F.col("title"), F.col("location"), F.col("description"))
    return _raw(spark, sf).select("ordinal", flags.detect_remote(scope).alias("remote"))


@query
def seniority(spark, sf):
    return _raw(spark, sf).select("ordinal", flags.detect_seniority(F.col("title")).alias("seniority"))


@query
def skill_tags(spark, sf):
    tags = skills.extract_skills(enrich.posting_text(), V.TAXONOMY, fuzzy=False)
    return _raw(spark, sf).select("ordinal", F.array_join(tags, "|").alias("skills"))


@query
def fuzzy_vocab(spark, sf):
    texts = _raw(spark, sf).select(F.col("description").alias("t"))
    for name in ("documents", "conversations", "benchmark"):
        texts = texts.unionByName(tables.spread_scan(bridge.table(spark, sf, name)).select(F.col("text").alias("t")))
    return enrich.fuzzy_vocabulary(texts, F.col("t")).withColumn("ratio", F.round("ratio", 4))


def _damaged_names(spark, sf):
    """Customer names with a letter lost, doubled, swapped with the next, or replaced, by order."""
    name, at = F.col("c_name"), (F.col("o_orderkey") % 17 + 1).cast("int")
    head, letter, following, tail = F.substr(name, F.lit(1), at - 1), F.substr(name, at, F.lit(1)), F.substr(name, at + 1, F.lit(1)), F.substr(name, at + 2)
    kind = F.col("o_orderkey") % 4
    token = F.when(kind == 0, F.concat(head, following, tail)).when(kind == 1, F.concat(head, letter, letter, following, tail)).when(
        kind == 2, F.concat(head, following, letter, tail)).otherwise(F.concat(head, F.lit("x"), following, tail))
    orders, customers = bridge.table(spark, sf, "orders"), bridge.table(spark, sf, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(token.alias("token"))


@query
def fuzzy_large_names(spark, sf):
    """The nearest of all customer and part names to each damaged name."""
    names = bridge.table(spark, sf, "customer").select(F.col("c_name").alias("name")).unionByName(
        bridge.table(spark, sf, "part").select(F.col("p_name").alias("name")))
    return near_names.nearest_names(_damaged_names(spark, sf), names, V.FUZZY_THRESHOLD).select("token", "name", *_money("ratio"))


@query
def enriched(spark, sf):
    rich = enrich.enrich(_unique(spark, sf))
    return rich.select(
        "job_id", "title", "seniority", "remote", "salary_min", "salary_max", "salary_currency",
        F.array_join("skills", "|").alias("skills"),
    )


@query
def entity_fill(spark, sf):
    gaps = _unique(spark, sf).withColumn("company", F.when(F.col("ordinal") % 3 != 0, F.col("company")))
    gazetteer = (
        bridge.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.lit("ORG").alias("kind"))
        .unionByName(bridge.table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit("GPE").alias("kind")))
    )
    return enrich.fill_entities(gaps, gazetteer).select("ordinal", "job_id", "company", "location")


@query
def process_batch(spark, sf):
    """Clean, de-duplicate, enrich and validate in one go."""
    done = batch.process_raw(_raw(spark, sf), _scraped())
    return done.valid.select(
        "job_id", "title", "company", "location", "remote", "salary_min", "salary_max", _text("posted_date"),
        F.size("skills").cast("long").alias("n_skills"),
    )


# --- HTML and comments -------------------------------------------------------------------------


def _feed(spark, sf):
    """Comments whose text is the posting description."""
    return _raw(spark, sf).select(
        "ordinal",
        F.col("ordinal").cast("string").alias("objectID"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("posted").alias("created_at"),
        F.col("description").alias("comment_text"),
    )


@query
def html_text(spark, sf):
    return _raw(spark, sf).select("ordinal", html.html_to_text(F.col("description")).alias("text"))


@query
def page_headings(spark, sf):
    heads = listing.page_elements(_pages(spark, sf), ["h1"])
    return heads.select("page_id", F.col("seq").cast("long").alias("seq"), "tag", "text")


@query
def page_elements(spark, sf):
    """Element rows of every page, counted by kind."""
    rows = listing.page_elements(_pages(spark, sf))
    return rows.groupBy("tag").agg(
        F.count(F.lit(1)).alias("elements"),
        F.count_if(F.size("classes") > 0).alias("with_class"),
        F.count_if(F.col("attrs")["href"].isNotNull()).alias("with_href"),
    )


@query
def page_cards(spark, sf):
    return listing.parse_listing(_pages(spark, sf), PAGE_SELECTORS).drop("description", "posted")


@query
def page_files(spark, sf):
    """Pages landed as one HTML file each, numbered by path, and their cards."""
    path = shared_dir(spark, "page-files")
    listing.land_pages(_pages(spark, sf), path)
    cards = listing.parse_listing(listing.read_pages(spark, path), PAGE_SELECTORS, F.lit("https://landed.example/list/"))
    return cards.select("ordinal", "title", "company", "location", "url")


@query
def card_dates(spark, sf):
    """Dates of cards: the attribute before the visible text, an empty one of them passed over."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 60).cast("int")), "yyyy-MM-dd")
    time = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('<time datetime="'), day, F.lit('">some day</time>'))).when(
        F.col("page_id") % 4 == 1, F.concat(F.lit("<time> <b>"), day, F.lit("</b> </time>"))).when(
        F.col("page_id") % 4 == 2, F.concat(F.lit('<time datetime="">on '), day, F.lit("</time>"))).otherwise(F.lit("<time></time>"))
    dated = _pages(spark, sf).withColumn("html", F.concat(
        F.substring_index("html", "<article>", 1), time, F.lit("<article>"), F.substring_index("html", "<article>", -1)))
    return listing.parse_listing(dated, PAGE_SELECTORS).select("ordinal", "title", "posted")


@query
def html_entities(spark, sf):
    """Entities by name, decimal and hexadecimal number, without semicolon, and such that are none."""
    forms = F.array(*map(F.lit, ["&eacute;", "&#233;", "&#xE9;", "&copy", "&frac12;", "&nosuch;", "&#x1F600;", "&lt;b&gt;", "&NotEqualTilde;"]))
    texts = _raw(spark, sf).select("ordinal", F.concat(F.lit("a "), F.get(forms, (F.col("ordinal") % 9).cast("int")), F.lit(" &amp; "), "company").alias("t"))
    return texts.select("ordinal", html.unescape(F.col("t")).alias("text"))


@query
def page_links(spark, sf):
    pages = _pages(spark, sf)
    links = listing.page_elements(pages, ["a"]).select(
        "page_id", F.col("seq").cast("long").alias("seq"), F.col("attrs")["href"].alias("href")
    )
    return links.join(pages.select("page_id", "url"), "page_id").select(
        "page_id", "seq", html.resolve_url(F.col("url"), F.col("href")).alias("link")
    )


@query
def url_allowed(spark, sf):
    pages = _pages(spark, sf).select("page_id", "url")
    hosts = pages.select(F.regexp_extract("url", "://([^/]*)", 1).alias("host")).distinct()
    rules = hosts.filter(~F.col("host").startswith("m.")).select(
        "host",
        F.inline(F.array(*[
            F.struct(F.lit(o).alias("ord"), F.lit(p).alias("prefix"), F.lit(a).alias("allow"))
            for o, p, a in [(1, "/en/1", True), (2, "/en", False), (3, "/de/2", False)]
        ])),
    )
    return listing.url_allowed(pages, rules)


@query
def url_allowed_many_rules(spark, sf):
    """Every order is a rule on one host, every page lies on it: the first of the rules that begin its path decides."""
    paths = _pages(spark, sf).select("page_id", F.concat(
        F.lit("https://rules.example/"), F.substring_index("url", "/", -2)).alias("url"))
    rules = bridge.table(spark, sf, "orders").select(
        F.lit("rules.example").alias("host"), F.col("o_orderkey").alias("ord"), F.concat(
            F.element_at(F.array(*map(F.lit, ["/en/", "/de/", "/fr/", "/es/"])), (F.col("o_custkey") % 4 + 1).cast("int")),
            (F.col("o_orderkey") % 1000).cast("string")).alias("prefix"),
        (F.col("o_orderkey") % 3 == 0).alias("allow"))
    return listing.url_allowed(paths, rules)


@query
def header_split(spark, sf):
    lines = _raw(spark, sf).select("ordinal", F.substring_index("description", "<p>", 1).alias("line"))
    split = lines.select("ordinal", comments.split_header(F.col("line")).alias("h"))
    return split.select("ordinal", "h.company", "h.title", "h.location")


@query
def comment_postings(spark, sf):
    return comments.parse_comments(_feed(spark, sf))


def _threads(spark, sf):
    turns = bridge.table(spark, sf, "conversations")
    return turns.filter("turn = 0").select(
        F.col("conv_id").alias("ordinal"),
        F.col("conv_id").cast("string").alias("objectID"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("Ask HN: Who is hiring?"))
        .otherwise(F.lit("Ask HN: Who wants to be hired?")).alias("title"),
    )


def _replies(spark, sf):
    """Turn 0 is the thread, turn 1 answers it, later turns answer the turn before."""
    turns = bridge.table(spark, sf, "conversations").filter("turn > 0")
    return turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("objectID"),
        F.when(F.col("turn") == 1, F.col("conv_id").cast("string"))
        .otherwise(F.concat_ws("-", "conv_id", F.col("turn") - 1)).alias("parent_id"),
        F.col("text").alias("comment_text"),
    )


@query
def hiring_threads(spark, sf):
    return comments.hiring_threads(_threads(spark, sf), 25)


@query
def top_level_comments(spark, sf):
    chosen = comments.hiring_threads(_threads(spark, sf), 25)
    found = comments.top_level_comments(_replies(spark, sf), chosen)
    return found.select("objectID", "parent_id", "thread_title", F.md5("comment_text").alias("digest"))


@query
def comment_hits(spark, sf):
    """Hits read out of JSON API pages."""
    hit = F.struct("objectID", "parent_id", "comment_text")
    pages = _replies(spark, sf).select(F.to_json(F.struct(F.array(hit).alias("hits"))).alias("body"))
    hits = comments.parse_hits(pages, "body")
    return hits.select("objectID", "parent_id", "created_at", F.length("comment_text").cast("long").alias("n"))


@query
def json_values(spark, sf):
    events = bridge.table(spark, sf, "events")
    k = F.coalesce(F.from_json("props", "k long")["k"], F.lit(0))
    return events.groupBy("event_type").agg(F.sum(k).alias("total"))


# --- alerts ------------------------------------------------------------------------------------


@query
def alert_matches(spark, sf):
    return alerts.alert_matches(_full_jobs(spark, sf), ALERT_WORDS).select("run_id", "job_id")


@query
def alert_gate(spark, sf):
    return alerts.alert_gate(_full_jobs(spark, sf), ALERT_WORDS, min_new=5)


@query
def alert_digest(spark, sf):
    rows = alerts.digest_rows(_full_jobs(spark, sf), ALERT_WORDS, min_new=5)
    return rows.select(
        "run_id", F.col("position").cast("long").alias("position"), "job_id", "title", "url", "meta", "brief",
        F.array_join("skills", "|").alias("skills"), "total_new", "matching", "more",
    )


@query
def alert_messages(spark, sf):
    return alerts.alert_messages(_full_jobs(spark, sf), ALERT_WORDS)


# --- sinks ---------------------------------------------------------------------------------------


@query
def csv_export(spark, sf):
    """The explorer table written as CSV and read back."""
    path = shared_dir(spark, "csv")
    table = analytics.explorer(filters.prepare_jobs(_full_jobs(spark, sf))).withColumn("posted", _text("posted"))
    table.write.option("header", True).option("escape", '"').csv(path)
    return spark.read.schema(table.schema).option("header", True).option("escape", '"').csv(path)


@query
def csv_append(spark, sf):
    """Two batches appended to the job CSV and read back."""
    path = shared_dir(spark, "jobs-csv")
    records = enrich.enrich(_unique(spark, sf), fuzzy=False)
    append_csv(records.filter("source = 'src0'"), path)
    append_csv(records.filter("source <> 'src0'"), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select("job_id", "source", "title", "remote", "skills", "posted_date", "scraped_at")


def _two_runs(spark, sf) -> JobStore:
    """Run 1 stores the postings of one source, run 2 everything."""
    store = JobStore(spark, shared_dir(spark, "store"))
    raw = _raw(spark, sf)
    for run_id, part in ((1, raw.filter("source = 'src1'")), (2, raw)):
        seen = F.lit(f"2026-01-0{run_id} 00:00:00").cast("timestamp")
        store.save_records(batch.process_raw(part, seen, fuzzy=False).valid, run_id)
    return store


@query
def store_jobs(spark, sf):
    jobs = _two_runs(spark, sf).jobs()
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return jobs.select("job_id", "run_id", "source", day("first_seen"), day("last_seen"))


@query
def store_base_delta(spark, sf):
    """Five runs, with a base after the third: the job table is that base plus the last two runs."""
    store, raw = JobStore(spark, shared_dir(spark, "store")), _raw(spark, sf)
    for run_id, part in enumerate((["src1"], ["src2"], ["src0", "src1"], ["src1"], ["src2"]), 1):
        seen = F.lit(f"2026-01-0{run_id} 00:00:00").cast("timestamp")
        rows = raw.filter(F.col("source").isin(part))
        store.save_records(batch.process_raw(rows, seen, fuzzy=False).valid, run_id)
        if run_id == 3:
            store.fold()
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return store.jobs().select("job_id", "run_id", "source", "title", day("first_seen"), day("last_seen"))


@query
def store_snapshots(spark, sf):
    store = _two_runs(spark, sf)
    for run_id in (1, 2):
        store.snapshot(run_id)
    return store.skill_snapshots().select("run_id", "skill", "job_count")


# --- streams -------------------------------------------------------------------------------------


def _event_stream(spark, sf):
    schema = bridge.table(spark, sf, "events").schema
    events = flows.read_folder(spark, sf, schema, "events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(spark, name, stream):
    path, checkpoint = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    flows.run_to_end(stream, path, checkpoint).awaitTermination()
    return spark.read.parquet(path)


@query
def stream_weekly(spark, sf):
    done = _finished(spark, "weekly", flows.weekly_counts(_event_stream(spark, sf)))
    return done.select(_text("week"), "jobs")


@query
def stream_weekly_filled(spark, sf):
    """The same with every third week's events left out: those weeks are told with 0."""
    kept = _event_stream(spark, sf).filter(F.weekofyear("ts") % 3 != 0)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    weeks.use_rocksdb(spark)
    try:
        done = _finished(spark, "weekly-filled", weeks.filled_weeks(kept))
    finally:
        spark.conf.set(setting, before)
    return done.select(_text("week"), "jobs")


@query
def stream_dedup(spark, sf):
    keyed = _event_stream(spark, sf).select("ts", "user_id", "event_type")
    first = flows.first_sightings(keyed, ["user_id", "event_type"], "ts", "60 days")
    return _finished(spark, "dedup", first).select("user_id", "event_type")


def _posting_stream(spark, sf):
    schema = bridge.table(spark, sf, "orders").schema
    orders = flows.read_folder(spark, sf, schema, "orders.parquet")
    return bridge.view(spark, sf, "raw_postings", orders=orders)


@query
def stream_ingest(spark, sf):
    store = JobStore(spark, shared_dir(spark, "ingest"))
    flows.ingest(_posting_stream(spark, sf), store, shared_dir(spark, "ingest-checkpoint"), _scraped()).awaitTermination()
    jobs = store.jobs()
    return jobs.select(
        "job_id", "title", "remote", "salary_min", F.array_join("skills", "|").alias("skills"),
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"),
    )


@query
def stream_alerts(spark, sf):
    rich = enrich.enrich(clean.clean(_posting_stream(spark, sf), _scraped()), fuzzy=False)
    path, checkpoint = shared_dir(spark, "alerts"), shared_dir(spark, "alerts-checkpoint")
    flows.alert_stream(rich, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("ordinal", "job_id", "title")


def _ingested(spark, sf) -> JobStore:
    store = JobStore(spark, shared_dir(spark, "ingest"))
    flows.ingest(_posting_stream(spark, sf), store, shared_dir(spark, "ingest-checkpoint"), _scraped()).awaitTermination()
    return store


@query
def stream_run_alerts(spark, sf):
    """All alerts that the stream stored: new jobs only, none cut off."""
    return _ingested(spark, sf).alerts().select("job_id", "title", "total_new", "matching")


@query
def stream_run_log(spark, sf):
    """Counters of the stream's runs, in total."""
    sums = [F.sum(c).alias(c) for c in ("records_fetched", "records_new", "records_invalid")]
    return _ingested(spark, sf).runs().groupBy("status").agg(*sums)


@query
def store_market(spark, sf):
    """The stored market table after two runs."""
    store = _two_runs(spark, sf)
    for run_id in (1, 2):
        store.snapshot(run_id)
    return store.market_snapshots().select("run_id", "total_jobs", "remote_jobs", "paid_jobs")


@query
def store_gap(spark, sf):
    """Run 1 is stored without a snapshot; run 2's snapshot counts its jobs all the same."""
    store = _two_runs(spark, sf)
    store.snapshot(2)
    return store.market_snapshots().select("run_id", "total_jobs")


@query
def store_stream_after_batch(spark, sf):
    """A stream with a new checkpoint into a store with a batch run: all jobs of both are there."""
    store = JobStore(spark, shared_dir(spark, "mixed"))
    raw, started = _raw(spark, sf).filter("source = 'src1'"), datetime(2026, 1, 1, tzinfo=timezone.utc)
    stats = batch.RunStats(run_id=store.start_run(started))
    batch.store_run(store, raw, stats, started, _scraped())
    flows.ingest(_posting_stream(spark, sf), store, shared_dir(spark, "mixed-checkpoint"), _scraped()).awaitTermination()
    return store.first_records().select("job_id", "title", "source", (F.col("run_id") == 1).alias("in_first"))


@query
def alerts_stored(spark, sf):
    """Every matching new job of a run, however many, and the run's counts."""
    store = _two_runs(spark, sf)
    for run_id in (1, 2):
        store.save_alerts(run_id)
    return store.alerts().select("run_id", "job_id", "title", "total_new", "matching")


@query
def stream_metrics(spark, sf):
    path, counts, checkpoint = (shared_dir(spark, n) for n in ("watched", "metrics", "metrics-checkpoint"))
    errors = F.count_if(F.col("event_type") == "error")
    flows.run_with_metrics(_event_stream(spark, sf), path, counts, checkpoint, errors).awaitTermination()
    return spark.read.parquet(counts).agg(F.sum("records").alias("records"), F.sum("extra_0").alias("invalid"))


@query
def stream_listener_metrics(spark, sf):
    """Two streams of 60 micro-batches with a checkpoint each, their counts in one folder: one row a micro-batch."""
    landing, out, counts = (shared_dir(spark, n) for n in ("landed-events", "listened", "listener-metrics"))
    events = bridge.table(spark, sf, "events").withColumn("part", F.pmod("event_id", F.lit(60)).cast("int"))
    for half in (0, 1):
        rows = events.filter(F.col("user_id") % 2 == half)
        rows.repartition(8, "part").write.partitionBy("part").parquet(f"{landing}/{half}")
    extra = {"errors": F.count_if(F.col("event_type") == "error"), "part": F.max("part"), "half": F.max(F.col("user_id") % 2)}
    log = metrics.ProgressLog(spark, counts, extra)
    spark.streams.addListener(log)
    try:
        for half in (0, 1):
            stream = flows.read_folder(spark, f"{landing}/{half}", events.schema, files_per_batch=1)
            log.wait(flows.run_to_end(metrics.watched(stream, extra), f"{out}/{half}", f"{out}-checkpoint-{half}"))
    finally:
        spark.streams.removeListener(log)
    return metrics.read_metrics(spark, log).filter("records > 0").select("half", "part", "records", "errors")
