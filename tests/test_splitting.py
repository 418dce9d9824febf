import pytest
from pyspark.sql import functions as F

from strideframe.operators import (
    bernoulli_sample,
    hash_sample,
    hot_groups,
    shuffled,
    split_rows,
    split_sizes,
    subject_split,
)
from tests.conftest import rows


def subjects(spark, n, copies=3):
    return spark.range(n * copies).select((F.col("id") % n + 1600).cast("int").alias("subject_id"))


@pytest.mark.parametrize("n, sizes", [(51, (30, 10, 11)), (5, (3, 1, 1)), (10, (6, 2, 2)), (1, (0, 0, 1)), (3, (1, 1, 1))])
def test_fractions(spark, n, sizes):
    got = {r.split: r.subjects for r in split_sizes(subject_split(subjects(spark, n))).collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == sizes


def test_order_is_ascending_and_disjoint(spark):
    split = {r.subject_id: r.split for r in subject_split(subjects(spark, 51)).collect()}
    assert len(split) == 51
    assert [split[s] for s in range(1600, 1651)] == ["train"] * 30 + ["val"] * 10 + ["test"] * 11


def test_counts(spark):
    split = {r.subject_id: r.split for r in subject_split(subjects(spark, 60), counts=(40, 6, 5)).collect()}
    assert [split.get(1600 + i) for i in (0, 39, 40, 45, 46, 50, 51)] == [
        "train", "train", "val", "val", "test", "test", "unused",
    ]
    with pytest.raises(ValueError):
        subject_split(subjects(spark, 5), counts=(1, 2))


def test_counts_lose_no_subject(spark):
    split = subject_split(subjects(spark, 100), counts=(40, 6, 5))
    assert split.count() == 100 and split.where("split = 'unused'").count() == 49


def test_many_subjects_take_the_split_way(spark):
    df = subjects(spark, 3000)
    distinct = df.distinct()
    hot = hot_groups(distinct, [], max_rows=100, part_rows=400)
    assert rows(subject_split(df, hot=hot)) == rows(subject_split(df, hot=None))


def test_split_rows(spark):
    df = subjects(spark, 10)
    split = subject_split(df)
    parts = [split_rows(df, split, s) for s in ("train", "val", "test")]
    assert [p.count() for p in parts] == [18, 6, 6]
    assert split_rows(spark.createDataFrame([(9999,)], "subject_id int"), split, "train").count() == 0


def test_hash_sample_ignores_the_layout(spark):
    df = spark.range(20_000)
    a = rows(hash_sample(df.repartition(3), "id", 0.1))
    assert a == rows(hash_sample(df.repartition(7), "id", 0.1))
    assert 1700 < len(a) < 2300
    assert hash_sample(df, "id", 0.0).count() == 0
    assert hash_sample(df, "id", 1.0).count() == 20_000


def test_hash_sample_of_large_negative_and_text_keys(spark):
    df = spark.createDataFrame([(2**62,), (-(2**62),), (-1,)], "id long")
    assert hash_sample(df, "id", 1.0).count() == 3
    text = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("j"))
    assert 350 < hash_sample(text, ["k", "j"], 0.1).count() < 650


def test_bernoulli_and_shuffle(spark):
    df = spark.range(10_000)
    assert 350 < bernoulli_sample(df, 0.05).count() < 650
    assert shuffled(df).count() == 10_000
    order = [r.id for r in shuffled(df).collect()]
    assert order != sorted(order) and order == [r.id for r in shuffled(df.repartition(7)).collect()]
    assert order != [r.id for r in shuffled(df, seed=1).collect()]
