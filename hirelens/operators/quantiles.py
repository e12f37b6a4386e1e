"""Exact quantiles whose work spreads over tasks however large one group is.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here an approximate sketch of bounded size first proposes a narrow bracket around each wanted
rank; exact counts per bracket, and per slice of the narrow brackets, then tell in which slice
each rank really lies; and only the values of those slices are put in order. The sketch decides
how small the slices are, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.operators.salting import join_per_key, salt

_ACCURACY = 1000
_MARGIN = 3.0 / _ACCURACY
_SLICES = 4096


def _cut_points(probs: Sequence[float]) -> list[float]:
    around = {min(1.0, max(0.0, p + side)) for p in probs for side in (-_MARGIN, _MARGIN)}
    return sorted(around | {0.0, 1.0})


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., n, q: array of interpolated quantiles in the order of ``probs``).

    Null values do not count; groups without a value have no row.
    """
    keys = list(keys)
    points = _cut_points(probs)
    present = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    cuts = present.groupBy(*keys).agg(F.percentile_approx("_v", points, _ACCURACY).alias("_cuts"))

    # Equal values merge before anything is compared.
    counted = present.groupBy(*keys, "_v", salt("_v").alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    with_cuts = (
        join_per_key(counted, cuts, keys) if keys else counted.withColumn("_cuts", cuts.select("_cuts").scalar())
    )
    # Bracket b holds the values above cut b - 1 and not above cut b.
    bracket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    narrow = [i for i in range(1, len(points)) if points[i] - points[i - 1] <= 2.5 * _MARGIN]
    low, high = F.get("_cuts", F.col("_bracket") - 1), F.get("_cuts", F.col("_bracket"))
    part = F.least(F.floor((F.col("_v") - low) / (high - low) * _SLICES), F.lit(_SLICES - 1)).cast("int")
    binned = with_cuts.withColumn("_bracket", bracket).select(
        *keys, "_salt", "_v", "_n", "_bracket",
        F.when(F.col("_bracket").isin(*narrow), part).otherwise(F.lit(0)).alias("_slice"),
    )

    # A few thousand rows per group at most.
    sizes = binned.groupBy(*keys, "_bracket", "_slice").agg(F.sum("_n").alias("_size"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    running = group.orderBy("_bracket", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumns(
        {"_before": F.coalesce(F.sum("_size").over(running), F.lit(0)), "_total": F.sum("_size").over(group)}
    )
    ranks = [side((F.col("_total") - 1) * F.lit(float(p))).cast("long") for p in probs for side in (F.floor, F.ceil)]
    here = F.filter(
        F.array_distinct(F.array(*ranks)),
        lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")),
    )
    # At most two slices per probability and group.
    needed = placed.withColumn("_ranks", here).filter(F.size("_ranks") > 0).groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        F.collect_list(F.struct("_bracket", "_slice", "_before", "_ranks")).alias("_needed"),
    )
    if keys:
        met = join_per_key(binned, needed, keys)
    else:
        met = binned.withColumn("_all", needed.select(F.struct("_total", "_needed")).scalar()).select("*", "_all.*")
    mine = F.get(
        F.filter(
            "_needed", lambda s: (s["_bracket"] == F.col("_bracket")) & (s["_slice"] == F.col("_slice"))
        ),
        F.lit(0),
    )
    inside = met.withColumn("_slot", mine).filter("_slot is not null")
    in_slice = Window.partitionBy(*keys, "_bracket", "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = inside.withColumn("_upto", F.col("_slot")["_before"] + F.sum("_n").over(in_slice))
    hits = ordered.select(
        *keys, "_total", "_v",
        F.explode(
            F.filter(
                F.col("_slot")["_ranks"],
                lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_n")),
            )
        ).alias("_rank"),
    )
    # At most two ranks per probability.
    grouped = hits.groupBy(*keys).agg(
        F.max("_total").alias("n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")
    )

    def quantile(p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(p))
        below = F.element_at("_at", F.floor(at).cast("long"))
        above = F.element_at("_at", F.ceil(at).cast("long"))
        return below + (above - below) * (at - F.floor(at))

    return grouped.filter("n is not null").select(
        *keys, "n", F.array(*[quantile(p) for p in probs]).alias("q")
    )
