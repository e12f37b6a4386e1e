"""Near misses of many names by deletion neighbourhoods.

Two words differ by i deletions here and j deletions there exactly if some word is left of both. So
all words left after up to k deletions are listed for names and tokens, and joined by equality: pairs
within k come out of one equality join, with their exact distance, and no pair beyond is ever compared.
Deletions that no length on the other side can meet are not listed, and the lists, many times the size
of the words, are never broadcast: Spark's size estimate does not know how many rows a list gives.
The taxonomy's own search (functions/skills) keeps its few names in the plan; this one takes any number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_less(words: Column) -> Column:
    """Distinct words left after deleting one letter of any of these."""
    def cuts(word: Column) -> Column:
        places = F.when(word != "", F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))

    return F.array_distinct(F.flatten(F.transform(words, cuts)))


def lengths_of(words: DataFrame, column: str) -> list[int]:
    """Lengths that occur, at most one a letter of the longest word."""
    return sorted(r[0] for r in words.select(F.length(column)).distinct().collect())


def useful_lengths(own: list[int], other: list[int], edits: int) -> list[list[int]]:
    """For each number of deletions, the lengths of words that meet a word of the other lengths within ``edits`` in all."""
    met = set(other)
    return [[n for n in own if any(n - gone + lost in met for lost in range(edits - gone + 1))] for gone in range(edits + 1)]


def neighbourhood(words: DataFrame, column: str, useful: list[list[int]]) -> DataFrame:
    """The frame once for each word left after k deletions, for words of a length in ``useful[k]``: ``_left``, and ``_gone``, how many."""
    none, length = F.array().cast("array<string>"), F.length(column)

    def of_length(lengths: list[int], found: Column) -> Column:
        return F.when(length.isin(lengths), found).otherwise(none) if lengths else none

    levels = words.withColumn("_w0", F.array(column))
    for k in range(1, len(useful)):
        deeper = sorted({n for lengths in useful[k:] for n in lengths})
        levels = levels.withColumn(f"_w{k}", of_length(deeper, _one_less(F.col(f"_w{k - 1}"))))
    every = F.concat(*[_counted(of_length(lengths, F.col(f"_w{k}")), k) for k, lengths in enumerate(useful)])
    return levels.select(*words.columns, F.inline(every))


def _counted(words: Column, gone: int) -> Column:
    return F.transform(words, lambda w: F.struct(w.alias("_left"), F.lit(gone).alias("_gone")))


def near_pairs(tokens: DataFrame, names: DataFrame, edits: int = 2) -> DataFrame:
    """(token, name, edits) of all pairs that at most ``edits`` insertions and deletions turn into each other.

    ``tokens`` has ``token``, ``names`` has ``name``; nulls pair with nothing, repeated ones count once.
    """
    tokens = tokens.select("token").where("token IS NOT NULL").distinct()
    names = names.select("name").where("name IS NOT NULL").distinct()
    of_tokens, of_names = lengths_of(tokens, "token"), lengths_of(names, "name")
    left = neighbourhood(tokens, "token", useful_lengths(of_tokens, of_names, edits))
    listed = neighbourhood(names, "name", useful_lengths(of_names, of_tokens, edits)).withColumnRenamed("_gone", "_lost")
    # A name's word is listed once for each number of deletions that a token may have: the join itself keeps to ``edits``.
    right = listed.withColumn("_gone", F.explode(F.sequence(F.lit(0), F.lit(edits) - F.col("_lost"))))
    met = left.join(right.hint("merge"), ["_left", "_gone"])
    return met.groupBy("token", "name").agg(F.min(F.col("_gone") + F.col("_lost")).alias("edits"))


def nearest_names(tokens: DataFrame, names: DataFrame, threshold: int, edits: int = 2) -> DataFrame:
    """(token, name, ratio): the closest name of each token, if at most ``edits`` apart and of at least that ratio.

    The ratio is the share of letters kept when only inserting and deleting, in percent; ties go to the
    alphabetically first name. A token that is a name is its own nearest.
    """
    total = F.length("token") + F.length("name")
    rated = near_pairs(tokens, names, edits).withColumn(
        "ratio", F.when(total == 0, 100.0).otherwise(100.0 * (total - F.col("edits")) / total))
    best = rated.where(F.col("ratio") >= threshold).groupBy("token").agg(F.min(F.struct(-F.col("ratio"), "name")).alias("b"))
    return best.select("token", F.col("b.name").alias("name"), (-F.col("b.col1")).alias("ratio"))
