import random

import numpy as np
from pyspark.sql import functions as F

from hirelens.llm.hard_negatives import bit_planes, mine, score, subset_sums

SCHEMA = "vec_id long, label int, vector array<bigint>, rank string, score int"


def brute(rows, every=10, positives=5, negatives=5):
    rows = [(i, l, v) for i, l, v, *_ in rows if None not in (i, l, v) and None not in v and all(abs(x) < 1 << 24 for x in v)]

    def points(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = set()
    for i, l, v in {(i, l, tuple(v)) for i, l, v in rows if i % every == 0}:
        ranked = sorted((-points(v, w), j, m) for j, m, w in rows if j != i)
        for p, j, m in [r for r in ranked if r[2] == l][:positives]:
            fits = [(n, k) for n, k, m in ranked if m != l and 80 * -p <= 100 * -n <= 100 * -p]
            out |= {(i, j, rank + 1, k, -p, -n) for rank, (n, k) in enumerate(fits[:negatives])}
    return sorted(out)


def mined(frame, every=10, **options):
    return sorted(map(tuple, mine(frame, F.col("vec_id") % every == 0, **options).collect()))


def drawn(pick, i, width, size):
    return i, pick.randrange(3), [pick.randrange(-size, size) + size // 4 for _ in range(pick.choice(width))], "x", 1


def test_scores_by_look_up():
    draw = np.random.default_rng(1)
    for width, size in ((1, 2), (7, 100), (8, 256), (65, 1 << 20), (64, 1 << 23)):
        a, b = draw.integers(-size, size, (5, width)), draw.integers(-size, size, (9, width))
        assert (score(subset_sums(a), bit_planes(b, width)) == b @ a.T).all()


def test_sign_digit_and_short_vectors():
    a = np.array([[-1, 2, -256, 255]])
    b = np.array([[-256, 255, 0, 1], [0, 0, 0, 0], [-1, -1, -1, -1]])
    assert (score(subset_sums(a), bit_planes(b, 4)) == b @ a.T).all()
    assert (score(subset_sums(a), bit_planes(b[:, :2], 4)) == b[:, :2] @ a[:, :2].T).all()


def test_against_brute_force(spark):
    pick = random.Random(3)
    rows = [drawn(pick, i, [16], 50) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    assert len(want) > 100 and mined(frame) == want
    # More parts of anchors give the same.
    assert mined(frame, anchors_at_once=7) == want


def test_odd_rows(spark):
    pick = random.Random(4)
    rows = [drawn(pick, i, [0, 1, 8, 9], 9) for i in range(120)]
    rows += rows[:40] + rows[:10]                                       # repeated rows
    rows += [drawn(pick, i, [9], 9) for i in (0, 10, 20, 20)]           # one identifier, several vectors
    rows += [(None, 1, [3, 3], "x", 1), (10, None, [1], "x", 1), (20, 1, None, "x", 1), (30, 1, [1, None], "x", 1),
             (40, 1, [1 << 24], "x", 1), (50, 0, [], "x", 1), (-10, 2, [4, 4, 4], "x", 1), (-20, 2, [-4, 4, 4], "x", 1)]
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(4), positives=7, negatives=3)
    assert sorted(set(got)) == brute(rows, positives=7, negatives=3)


def test_ties_go_to_the_smaller_identifier(spark):
    rows = [(i, i % 2, [5, 5], "x", 1) for i in range(40)]
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(5), every=100)
    assert got == [(0, p, r + 1, 2 * r + 1, 50, 50) for p in (2, 4, 6, 8, 10) for r in range(5)]


def test_empty_and_alone(spark):
    frame = spark.createDataFrame([(10, 1, [1], "x", 1)], SCHEMA)
    assert mined(frame) == [] and mined(frame.limit(0)) == []
    assert mine(frame.limit(0), F.col("vec_id") % 10 == 0).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
