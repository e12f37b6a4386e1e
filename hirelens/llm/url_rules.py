"""URL filtering by fixed host/path rules and, where none fits, by mined association rules.

Labelled URLs become transactions of tokens (words of the host, words of path and query; numbers are
one token) plus one item for the label. Spark's FP-growth finds token combinations that
imply "block"; rules under the wanted support or confidence fall away, and so does every rule that
a more general rule with at least its confidence covers. Rules are matched through an inverted
index: a rule is posted under its rarest token only, a URL looks up its tokens, and the rest of
the rule's tokens are then checked. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import stored
from hirelens.sources.tables import read_parquet

# The rules of the query, (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BLOCKED = "=block"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, nulls if none fits. The rules are part of the plan."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name = verdict = None
    for kind, rule_host, rule_path in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path) if name is None else name.when(fits, rule_host + rule_path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if name is None else (name, verdict)


def tokens(url: Column) -> Column:
    """Distinct tokens: pieces between punctuation, marked by where they stand (host or rest). Numbers are one token."""
    lowered = F.lower(F.coalesce(url, F.lit("")))
    def pieces(text: Column, mark: str) -> Column:
        words = F.filter(F.split(text, r"[^\p{L}\p{N}-]+"), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark), F.when(w.rlike("^[0-9]+$"), F.lit("0")).otherwise(w)))
    host = F.regexp_extract(lowered, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_extract(lowered, r"(?s)^(?:.*?://[^/?#]*)?(.*)$", 1)
    return F.array_distinct(F.concat(pieces(host, "h:"), pieces(rest, "p:")))


def mine(labelled: DataFrame, url_col: str, bad_col: str, support: float, confidence: float,
         least_rows: int = 20, least_errors: float = 4.5) -> DataFrame:
    """Rules (rule_id, tokens, confidence, support) that imply "block".

    ``support`` and ``confidence`` are fractions of the labelled rows and of a combination's rows. A rule
    also needs ``least_rows`` bad rows, and a share of bad ones at least ``least_errors`` standard errors above
    that of all labelled rows: by chance, a combination gets there about three times in a million.
    Rows without a label teach nothing. With no labelled row there is no rule.
    """
    known = labelled.where(F.col(bad_col).isNotNull())
    items = F.concat(tokens(F.col(url_col)), F.when(F.col(bad_col), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>")))
    baskets = stored(known.select(items.alias("items")).where(F.size("items") > 0), "url-baskets")
    if baskets.isEmpty():
        return baskets.select(F.lit(0).cast("long").alias("rule_id"), F.col("items").alias("needs"),
                              F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")).limit(0)
    rows, bad = baskets.agg(F.count(F.lit(1)), F.count_if(F.array_contains("items", BLOCKED))).first()
    base, least = bad / rows, max(support, least_rows / rows)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least), minConfidence=confidence).fit(baskets)
    holding = F.col("support") * rows / F.col("confidence")
    errors = (F.col("confidence") - base) * F.sqrt(holding) / max((base * (1 - base)) ** 0.5, 1e-9)
    found = model.associationRules.where((F.element_at("consequent", 1) == BLOCKED) & (errors >= least_errors)).where(
        F.round(F.col("support") * rows) >= least_rows).select(F.array_sort("antecedent").alias("needs"), "confidence", "support")
    found = stored(found.withColumn("rule_id", F.xxhash64(F.array_join("needs", "\n"))), "url-rules")
    return stored(general_rules(found), "url-rules-kept")


def general_rules(found: DataFrame) -> DataFrame:
    """Rules that no shorter rule with at least the same confidence makes superfluous.

    A more general rule shares every one of its tokens with the rule, so both meet at the general
    rule's first token.
    """
    short = found.select(F.col("rule_id").alias("short_id"), F.col("needs").alias("short"),
                         F.col("confidence").alias("short_confidence"), F.element_at("needs", 1).alias("token"))
    covered = (found.select("rule_id", "needs", "confidence", F.explode("needs").alias("token")).join(short, "token")
               .where((F.size("short") < F.size("needs")) & (F.col("short_confidence") >= F.col("confidence"))
                      & (F.size(F.array_except("short", "needs")) == 0)))
    return found.join(covered.select("rule_id").distinct(), "rule_id", "left_anti")


def inverted_index(rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """Each rule posted under its rarest token (ties: first in order)."""
    rarest = (rules.select("rule_id", F.explode("needs").alias("token")).join(frequency, "token", "left")
              .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("rows", F.lit(0)), "token")).alias("rare")))
    return rules.join(rarest, "rule_id").select(F.col("rare.token").alias("token"), "rule_id", "needs", "confidence")


def blocked_by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that some rule fits, with the confidence of the best one.

    ``urls`` has one column ``url``. Look-ups join a URL's tokens with the index; only URLs that
    have a rule's rarest token carry on to the containment check.
    """
    cut = urls.select("url", tokens(F.col("url")).alias("tokens"))
    pairs = cut.select("url", "tokens", F.explode("tokens").alias("token"))
    frequency = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    wanted = rules.select(F.explode("needs").alias("token")).distinct()
    index = stored(inverted_index(rules, frequency.join(wanted, "token", "left_semi")), "url-index")
    hits = pairs.join(index, "token").where(F.size(F.array_except("needs", "tokens")) == 0)
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
          label_id: str = "doc_id", quality_col: str = "quality", support: float = 0.002,
          confidence: float = 0.25, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, confidence (of the mined rule, if one fits).

    ``labels`` marks pages by identifier; quality 0 means block. A page is blocked by the method
    if a mined rule fits, else allowed. A null url has empty host and path, no rule and no token:
    allow. Rows with repeated or null identifiers are judged like any other; identifiers labelled
    twice teach twice. Other columns are not read.
    """
    page = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    label = labels.select(F.col(label_id).alias("page_id"), (F.col(quality_col) == 0).alias("bad"))
    learnt = mine(page.join(label, "page_id").select("url", "bad"), "url", "bad", support, confidence)
    urls = page.select("url").where(F.col("url").isNotNull()).distinct()
    fitting = blocked_by_rules(urls, learnt)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return (page.join(fitting, "url", "left").withColumns({"host": host, "path": path})
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "confidence"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, fitting rule and verdict."""
    return judge(read_parquet(spark, f"{sf_dir}/pages.parquet"), read_parquet(spark, f"{sf_dir}/labels.parquet"))
