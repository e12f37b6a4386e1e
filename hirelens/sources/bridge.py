"""Job-market views over the star-schema tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hirelens.sources.tables import read_parquet, spread_scan

JOBS = """
SELECT CAST(o_orderkey AS STRING) AS job_id, o_orderkey AS ordinal,
  c_mktsegment AS source,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE c_name END AS company,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE n_name END AS location,
  o_orderstatus = 'F' AS remote,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS seniority,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS salary_min,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice + 10000 END AS salary_max,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'EUR'
    WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'USD' END AS salary_currency,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS posted_date,
  CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS run_id,
  CAST(o_orderdate AS DATE) AS first_seen
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

JOB_SKILLS = """
SELECT DISTINCT CAST(l_orderkey AS STRING) AS job_id, p_brand AS skill
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

# {copies} yields column dup: 0 for every order, and 1 for every tenth.
RAW_POSTINGS = """
SELECT k * 2 + dup AS ordinal, 'src' || CAST(k % 3 AS STRING) AS source,
  CASE WHEN k % 97 = 0 THEN '   ' WHEN dup = 1 THEN upper(lvl) || '  ' || upper(rl) || ' '
    ELSE ' ' || lvl || '  ' || rl END AS title,
  CASE WHEN dup = 1 THEN upper(c_name) ELSE c_name END AS company,
  CASE k % 4 WHEN 0 THEN '  new york ,NY. ' WHEN 1 THEN 'REMOTE (EU)'
    WHEN 2 THEN lower(replace(n_name, '_', ' ')) || ' , emea' ELSE NULL END AS location,
  CASE k % 7 WHEN 0 THEN y || '-' || m2 || '-' || d2 WHEN 1 THEN y || '-' || m2 || '-' || d2 || 'T23:30:00.000Z'
    WHEN 2 THEN mn || ' ' || d1 || ', ' || y WHEN 3 THEN d1 || ' ' || mn || ' ' || y
    WHEN 4 THEN d2 || '/' || m2 || '/' || y WHEN 5 THEN 'not a date' ELSE NULL END AS posted,
  CASE WHEN k % 8 = 0 THEN 'javascript:alert(1)'
    ELSE 'https://example.com/jobs/' || CAST(k AS STRING) END AS url,
  c_name || ' | ' || lvl || ' ' || rl || ' | ' || n_name || ' | ' || rem || ' | ' ||
  CASE k % 7 WHEN 0 THEN '$' || lo || 'k-$' || hi || 'k' WHEN 1 THEN '$' || lo || ',000 - $' || hi || ',000'
    WHEN 2 THEN '€' || lo || 'k – ' || hi || 'k' WHEN 3 THEN lo || '-' || hi || 'k USD'
    WHEN 4 THEN 'up to $' || hi || 'k+' WHEN 5 THEN '$50-$60 per hour' ELSE 'We raised $200 million' END
  || '<p>Stack: ' || s1 || ', ' || s2 || ' &amp; ' || s3 || '.' AS description
FROM (SELECT b.*, dup FROM (SELECT o_orderkey AS k, c_name, n_name,
  CASE o_orderkey % 5 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Senior' WHEN 2 THEN 'Lead' WHEN 3 THEN 'Intern' ELSE 'Mid' END AS lvl,
  CASE o_orderkey % 6 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Data Analyst' WHEN 2 THEN 'Platform Developer'
    WHEN 3 THEN 'Engineering Manager' WHEN 4 THEN 'Research Scientist' ELSE 'Solutions Architect' END AS rl,
  CASE o_orderkey % 11 WHEN 0 THEN 'REMOTE' WHEN 1 THEN 'no remote' WHEN 2 THEN 'work from home'
    WHEN 3 THEN 'on-site only' WHEN 4 THEN 'remote is not available' ELSE 'office' END AS rem,
  CASE o_orderkey % 9 WHEN 0 THEN 'JavaScript' WHEN 1 THEN 'Java' WHEN 2 THEN 'C++' WHEN 3 THEN 'C#' WHEN 4 THEN '.NET'
    WHEN 5 THEN 'Go' WHEN 6 THEN 'go' WHEN 7 THEN 'GitHub' ELSE 'postgres' END AS s1,
  CASE o_orderkey % 8 WHEN 0 THEN 'Python' WHEN 1 THEN 'k8s' WHEN 2 THEN 'Kubernetess' WHEN 3 THEN 'Kuberentes'
    WHEN 4 THEN 'Terraformm' WHEN 5 THEN 'Node.js' WHEN 6 THEN 'SQL' ELSE 'swift' END AS s2,
  CASE o_orderkey % 13 WHEN 0 THEN 'Spark' WHEN 1 THEN 'machine  learning' WHEN 2 THEN 'RUST'
    WHEN 3 THEN 'GitHub Actions' ELSE 'Docker' END AS s3,
  CAST(60 + o_orderkey % 90 AS STRING) AS lo, CAST(160 + o_orderkey % 41 AS STRING) AS hi,
  CAST(year(o_orderdate) AS STRING) AS y, CAST(day(o_orderdate) AS STRING) AS d1,
  lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m2, lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d2,
  CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April'
    WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September'
    WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END AS mn
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) b {copies}) z
"""
_SPARK_COPIES = "LATERAL VIEW explode(CASE WHEN k % 10 = 0 THEN array(0, 1) ELSE array(0) END) c AS dup"
_ORACLE_COPIES = "CROSS JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) t WHERE dup = 0 OR k % 10 = 0"

# Sightings of the same job in several runs: one when it is posted, one per later month in
# which a line ships. Text and salary differ from sighting to sighting.
OBSERVATIONS = """
SELECT CAST(o_orderkey AS STRING) AS job_id,
  CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS run_id,
  CAST(0 AS BIGINT) AS ordinal, CAST(o_orderdate AS DATE) AS seen_on,
  'posted ' || o_orderpriority AS title, o_totalprice AS salary_min
FROM orders
UNION ALL
SELECT CAST(l_orderkey AS STRING) AS job_id,
  CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT) AS run_id,
  (l_linenumber * CAST(1000000000 AS BIGINT) + l_partkey) * 100000 + l_suppkey AS ordinal, CAST(l_shipdate AS DATE) AS seen_on,
  'line ' || CAST(l_linenumber AS STRING) AS title, l_extendedprice AS salary_min
FROM lineitem
"""

VIEWS = {"jobs": JOBS, "job_skills": JOB_SKILLS, "raw_postings": RAW_POSTINGS, "observations": OBSERVATIONS}
_INPUTS = {
    "jobs": ["orders", "customer", "nation"],
    "job_skills": ["lineitem", "part"],
    "raw_postings": ["orders", "customer", "nation"],
    "observations": ["orders", "lineitem"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A bridge view over the tables of a folder; ``given`` replaces tables (e.g. by streams)."""
    sql = VIEWS[name].replace("{copies}", _SPARK_COPIES)
    inputs = {t: given.get(t, table(spark, sf_dir, t)) for t in _INPUTS[name]}
    if name == "raw_postings":
        inputs["orders"] = spread_scan(inputs["orders"])
    # Names of their own for each call: views of two threads must not meet.
    call = uuid.uuid4().hex
    for t, df in inputs.items():
        df.createOrReplaceTempView(f"_bridge_{t}_{call}")
    ctes = ", ".join(f"{t} AS (SELECT * FROM _bridge_{t}_{call})" for t in inputs)
    return spark.sql(f"WITH {ctes} {sql}")


def oracle(name: str) -> str:
    """The same view as a DuckDB query."""
    return VIEWS[name].replace("{copies}", _ORACLE_COPIES)
