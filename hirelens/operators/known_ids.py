"""Skip index over known identifiers: Bloom bits by hash bucket, kept as Spark bitmaps.

A bucket's bits lie in chunks of 32,768 (one bitmap of 4 KB). An identifier has all its bits in one
chunk, so that a look-up is one join row. A clear bit proves that an identifier is new; where all
bits are set it may be known, which the identifiers of that bucket then decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 32_768
BITS_PER_ID = 12
HASHES = 6


def bucket_of(identifier: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(identifier), F.lit(buckets)).cast("int")


def chunks_for(ids: int, buckets: int) -> int:
    """Chunks of each bucket for so many identifiers in all."""
    return max(1, -(-ids * BITS_PER_ID // (buckets * CHUNK)))


def _chunk(identifier: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(identifier, F.lit("chunk")), F.lit(chunks)).cast("int")


def _bits(identifier: Column) -> Column:
    """Places of an identifier's bits in its chunk."""
    return F.array(*[F.pmod(F.xxhash64(identifier, F.lit(k)), F.lit(CHUNK)) for k in range(HASHES)])


def build_index(ids: DataFrame, buckets: int, chunks: int, key: str = "job_id") -> DataFrame:
    """(bucket, chunk, bits) over the identifiers; null ones are left out."""
    found = ids.where(F.col(key).isNotNull()).select(
        bucket_of(F.col(key), buckets).alias("bucket"), _chunk(F.col(key), chunks).alias("chunk"),
        F.explode(_bits(F.col(key))).alias("bit"))
    # Bitmaps are merged before the shuffle, so a task sends 4 KB a chunk at most.
    return found.groupBy("bucket", "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_be_known(rows: DataFrame, index: DataFrame, buckets: int, chunks: int, key: str = "job_id") -> DataFrame:
    """(bucket, key) of the rows whose identifier has all its bits set: all known ones and a few others."""
    asked = rows.select(key, bucket_of(F.col(key), buckets).alias("bucket"), _chunk(F.col(key), chunks).alias("chunk"))

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        return F.getbit(byte, place % 8) == 1

    return asked.join(index, ["bucket", "chunk"]).where(F.forall(_bits(F.col(key)), is_set)).select("bucket", key)


def known_among(rows: DataFrame, known: DataFrame, index: DataFrame, buckets: int, chunks: int,
                key: str = "job_id") -> DataFrame:
    """Identifiers of the rows that are known, decided by ``known`` (bucket, key, ...), of which only the
    buckets that may hold one are read."""
    asked = may_be_known(rows, index, buckets, chunks, key).distinct()
    # At most one number a bucket comes to the driver; table folders are pruned by it before the scan.
    touched = [r.bucket for r in asked.select("bucket").distinct().collect()]
    return known.where(F.col("bucket").isin(touched)).join(asked, ["bucket", key], "left_semi").select(key)
