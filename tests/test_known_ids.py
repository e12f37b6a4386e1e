from pyspark.sql import functions as F

from hirelens.operators import known_ids as K


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "job_id string")


def test_no_known_id_is_missed_and_few_others_pass(spark):
    known, other = [f"k{i}" for i in range(20_000)], [f"o{i}" for i in range(20_000)]
    chunks = K.chunks_for(len(known), 3)
    index = K.build_index(frame(spark, known + known[:100]), 3, chunks).cache()
    assert index.count() <= 3 * chunks
    found = {r.job_id for r in K.may_be_known(frame(spark, known + other), index, 3, chunks).collect()}
    assert found >= set(known) and len(found) - len(known) < 400


def test_false_hits_are_decided(spark):
    """One chunk for far too many ids: nearly all bits are set, the answer stays exact."""
    known, asked = [f"k{i}" for i in range(40_000)], [f"o{i}" for i in range(300)] + ["k7", "k39999", "k7"]
    stored = frame(spark, known).withColumn("bucket", K.bucket_of(F.col("job_id"), 1))
    index = K.build_index(frame(spark, known), 1, 1)
    assert K.may_be_known(frame(spark, asked), index, 1, 1).count() > 250
    got = K.known_among(frame(spark, asked), stored, index, 1, 1)
    assert sorted(r.job_id for r in got.collect()) == ["k39999", "k7"]


def test_nulls_and_nothing(spark):
    index = K.build_index(frame(spark, [None]), 4, 1)
    assert index.count() == 0
    assert K.may_be_known(frame(spark, [None, "a"]), index, 4, 1).count() == 0
    assert K.may_be_known(frame(spark, [None]), K.build_index(frame(spark, ["a"]), 4, 1), 4, 1).count() == 0
