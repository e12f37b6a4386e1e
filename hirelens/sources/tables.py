"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Session setting: into how many partitions scans of text-heavy tables are dealt before the text
# work. Without it a scan that offers fewer than TASKS_A_CORE splits a core is dealt to so many:
# Parquet can't be split inside a row group, and narrow rows become costly only afterwards.
SCAN_PARTITIONS = "spark.hirelens.scanPartitions"
TASKS_A_CORE = 4


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread_scan(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a table scan to ``partitions`` or what the session setting says, else to all cores if it has too few splits.

    The splits of a stream are known micro-batch by micro-batch only, so it is always dealt.
    """
    wanted = partitions or scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    if wanted:
        return scan.repartition(int(wanted))
    enough = TASKS_A_CORE * scan.sparkSession.sparkContext.defaultParallelism
    return scan if not scan.isStreaming and scan.rdd.getNumPartitions() >= enough else scan.repartition(enough)
