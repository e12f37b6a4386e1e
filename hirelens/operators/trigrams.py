"""Literal search through a stored trigram index.

For every run of three letters there are rows (trigram, number of ids, ids), one for each batch of texts
that holds it, kept in hash buckets and ordered by trigram. Each task lists the runs of its own texts, so
neither texts nor ids are shuffled, and a run that all texts hold is spread over all tasks.
A text can only hold a query if it holds all the query's trigrams, so the ids of the rarest
one are read from its bucket, and those texts alone are searched. Shorter queries scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 3


def postings(rows: DataFrame, key: str, text: Column) -> DataFrame:
    """(trigram, texts, ids) of each Arrow batch: its distinct runs of three letters and the rows that hold them."""
    kind, size = rows.schema[key].dataType.simpleString(), SIZE

    def listed(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).fill_null("")
            letters = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
            holder = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            places = max(len(letters) - size + 1, 0)
            # A letter is below 2^21, so a run of three is one number; runs end where their text ends.
            runs = sum(letters[k:k + places] << 21 * (size - 1 - k) for k in range(size))
            inside = holder[:places] == holder[size - 1:]
            runs, holder = runs[inside], holder[:places][inside]
            if not len(runs):
                continue
            order = np.argsort(runs, kind="stable")
            runs, holder = runs[order], holder[order]
            new_run = np.diff(runs, prepend=-1) != 0
            once = new_run | (np.diff(holder, prepend=-1) != 0)
            starts, runs = np.flatnonzero(new_run[once]), runs[new_run]
            ends = np.append(starts[1:], once.sum())
            codes = (runs[:, None] >> 21 * np.arange(size - 1, -1, -1)) & (1 << 21) - 1
            whole = codes.astype("<u4").tobytes().decode("utf-32-le")
            yield pa.record_batch({
                "trigram": pa.array([whole[k:k + size] for k in range(0, len(whole), size)], pa.string()),
                "texts": pa.array(ends - starts, pa.int64()),
                "ids": pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids.take(pa.array(holder[once]))),
            })

    return rows.select(key, F.lower(text).alias("_text")).mapInArrow(listed, f"trigram string, texts long, ids array<{kind}>")


def _bucket(trigram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class TrigramIndex:
    """Postings and counts below a folder. ``key`` names the identifier column."""

    spark: SparkSession
    path: str
    key: str
    kind: str
    buckets: int

    @classmethod
    def build(cls, rows: DataFrame, key: str, text: Column, path: str, buckets: int = 64) -> "TrigramIndex":
        """Index a frame; each task writes one file a bucket."""
        placed = postings(rows, key, text).withColumn("bucket", _bucket(F.col("trigram"), buckets))
        placed.sortWithinPartitions("bucket", "trigram").write.partitionBy("bucket").parquet(f"{path}/postings")
        index = cls(rows.sparkSession, path, key, rows.schema[key].dataType.simpleString(), buckets)
        counts = index._table("postings").groupBy("bucket", "trigram").agg(F.sum("texts").alias("texts"))
        counts.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/counts")
        return index

    def _table(self, name: str) -> DataFrame:
        own = f", ids array<{self.kind}>" if name == "postings" else ""
        return self.spark.read.schema(f"trigram string, texts long{own}, bucket int").parquet(f"{self.path}/{name}")

    def _of(self, table: str, grams: list[str]) -> DataFrame:
        rows = self._table(table)
        # Constants after folding: only these buckets' folders are read.
        asked = [_bucket(F.lit(g), self.buckets) for g in grams]
        return rows.where(F.col("bucket").isin(asked) & F.col("trigram").isin(grams))

    def search(self, rows: DataFrame, text: Column, query: str) -> DataFrame:
        """The rows whose text, lower-cased, holds the query, lower-cased; ``rows`` are those indexed."""
        wanted = query.lower()
        exact = F.contains(F.lower(text), F.lit(wanted))
        grams = sorted({wanted[k:k + SIZE] for k in range(len(wanted) - SIZE + 1)})
        if not grams:
            return rows.where(exact)
        # At most one row a trigram of the query.
        found = self._of("counts", grams).select("trigram", "texts").collect()
        if len(found) < len(grams):
            return rows.where(F.lit(False))
        rarest = min(found, key=lambda r: (r.texts, r.trigram)).trigram
        ids = self._of("postings", [rarest]).select(F.explode("ids").alias(self.key))
        return rows.join(ids, self.key, "left_semi").where(exact)
