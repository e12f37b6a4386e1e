"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def salt(*columns: str | Column, salts: int = SALTS) -> Column:
    return F.pmod(F.hash(*columns), F.lit(salts))


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner",
                 salts: int = SALTS) -> DataFrame:
    """Join ``rows``, which has a ``_salt``, with one row per key; null keys match.

    The rows of a hot key meet copies of its row in ``salts`` partitions. No broadcast is
    asked for, Spark decides by size.
    """
    renamed = per_key.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in per_key.columns],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_r__salt"),
    )
    on = [F.col("_salt") == F.col("_r__salt"), *[F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]]
    return rows.join(renamed, reduce(and_, on), how).drop("_r__salt", *[f"_r_{k}" for k in keys])
