"""Near names, literal search and weeks through their indexes and states, against plain rules."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hirelens.operators.near_names import near_pairs, nearest_names
from hirelens.operators.trigrams import TrigramIndex
from hirelens.streaming import flows, weeks


def distance(a, b):
    """Fewest insertions and deletions."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_pairs_and_their_distance(spark, edits):
    pick = random.Random(edits)
    words = ["".join(pick.choices("abc", k=pick.randrange(7))) for _ in range(120)]
    tokens, names = words[:60] + words[:5] + [None], words[60:] + words[:3] + [None]
    got = near_pairs(spark.createDataFrame([(t,) for t in tokens], "token string"),
                     spark.createDataFrame([(n,) for n in names], "name string"), edits).collect()
    want = {(t, n): distance(t, n) for t in tokens if t is not None for n in names if n is not None}
    assert {(r.token, r.name): r.edits for r in got} == {k: d for k, d in want.items() if d <= edits} and len(got) == len(
        {k for k, d in want.items() if d <= edits})


def test_nearest_of_many(spark):
    names = spark.createDataFrame([("kubernetes",), ("terraform",), ("terraforms",), ("",)], "name string")
    tokens = spark.createDataFrame([(t,) for t in ("kubernets", "kuberentes", "terrafform", "terraforms", "docker", "")], "token string")
    got = {r.token: (r.name, round(r.ratio, 2)) for r in nearest_names(tokens, names, 90).collect()}
    assert got == {"kubernets": ("kubernetes", 94.74), "kuberentes": ("kubernetes", 90.0), "terrafform": ("terraform", 94.74),
                   "terraforms": ("terraforms", 100.0), "": ("", 100.0)}


def test_literal_search(spark, tmp_path):
    pick = random.Random(3)
    texts = ["".join(pick.choices("aAbB .é", k=pick.randrange(30))) for _ in range(300)] + [None, "", "ab", "abc"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    index = TrigramIndex.build(rows, "id", F.col("t"), str(tmp_path / "index"), buckets=5)
    for query in ["ab", "", "a", "abb", "ABA", "é.a", "aab ", "bab.ab", "zzz", texts[7], texts[8][2:9]]:
        got = sorted(r.id for r in index.search(rows, F.col("t"), query).collect())
        assert got == [k for k, t in enumerate(texts) if t is not None and query.lower() in t.lower()], query
    plan = index.search(rows, F.col("t"), "abba")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_index_of_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "ab")], "id int, t string")
    index = TrigramIndex.build(rows, "id", F.col("t"), str(tmp_path / "index"))
    assert [r.id for r in index.search(rows, F.col("t"), "AB").collect()] == [2]


def test_weeks_without_rows_are_told(spark, tmp_path):
    days = [datetime(2024, 1, 1) + timedelta(days=k) for k in (0, 1, 2, 9, 30, 31, 60)]
    for part in (days[:3], days[3:5], days[5:]):
        spark.createDataFrame([(d,) for d in part], "ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    weeks.use_rocksdb(spark)
    try:
        stream = flows.read_folder(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
        flows.run_to_end(weeks.filled_weeks(stream), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    finally:
        spark.conf.set(setting, before)
    got = sorted((r.week, r.jobs) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    first = date(2024, 1, 7)
    assert got == [(first + timedelta(weeks=k), n) for k, n in enumerate([3, 1, 0, 0, 2, 0, 0, 0])]
