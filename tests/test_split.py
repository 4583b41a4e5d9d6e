"""Keyed split and folds: a partition of the keys, stable under repartition."""

from riskloom.operators import split


def test_split_is_partition_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    tr, te = split.hash_split(df, "key")
    a = {r.key for r in tr.collect()}
    b = {r.key for r in te.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.77 < len(a) / 5000 < 0.83
    for n in (1, 7):
        tr2, _ = split.hash_split(df.repartition(n), "key")
        assert {r.key for r in tr2.collect()} == a


def test_folds(spark):
    df = spark.range(3000).withColumnRenamed("id", "key")
    f = split.assign_folds(df, "key")
    counts = dict(f.groupBy("fold").count().collect())
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 900
    again = dict((r.key, r.fold) for r in split.assign_folds(df.repartition(5), "key").collect())
    assert again == dict((r.key, r.fold) for r in f.collect())
