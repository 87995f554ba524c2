import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from prosemill.operators import sampling as Sa
from tests.conftest import rows


def labelled(spark, zeros, ones, partitions=1):
    data = [(i, 0 if i < zeros else 1) for i in range(zeros + ones)]
    return spark.createDataFrame(data, "article_id long, label int").repartition(partitions)


def counts(df, *keys):
    return {tuple(r[:-1]): r[-1] for r in rows(df.groupBy(*keys).count())}


def test_downsample_rule(spark):
    small = labelled(spark, 3, 10)
    assert Sa.downsample(small, 5).count() == 13
    assert counts(Sa.downsample(small, 3), "label") == {(0,): 3, (1,): 3}


def test_too_small_classes_are_refused(spark):
    with pytest.raises(ValueError, match=r"\[0\]"):
        Sa.label_samples(labelled(spark, 3, 10), 5, id_col="article_id")
    for refused in (labelled(spark, 1, 20), labelled(spark, 0, 0)):
        split = Sa.sample_and_split(refused)  # starts no job
        with pytest.raises(PySparkException, match="Too few rows"):
            split.count()


def test_split_sizes_and_membership(spark):
    expected = {
        (label, part): size for label in (0, 1) for part, size in (("train", 8), ("val", 1), ("test", 1))
    }
    members = None
    for partitions in (1, 4, 50):
        split = Sa.sample_and_split(labelled(spark, 10, 10, partitions))
        assert counts(split, "label", "split") == expected
        found = set(rows(split, "article_id", "split"))
        assert members in (None, found)
        members = found
    other = set(rows(Sa.sample_and_split(labelled(spark, 10, 10), seed=7), "article_id", "split"))
    assert other != members


def test_sampled_split_covers_the_sample_once(spark):
    split = Sa.sample_and_split(labelled(spark, 700, 2100, 5), 600)
    assert counts(split, "split") == {("train",): 960, ("val",): 120, ("test",): 120}
    assert split.select("article_id").distinct().count() == 1200
    same = set(rows(Sa.downsample(labelled(spark, 700, 2100), 600), "article_id"))
    assert same == set(rows(split, "article_id"))


def quotas(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "label int, rows long")
    found = {r[0]: (r[1], r[2]) for r in rows(Sa.split_quotas(table), "label", "train", "val")}
    return {k: v[0] for k, v in found.items()}, {k: v[1] for k, v in found.items()}


@pytest.mark.parametrize("sizes", [{0: 41, 1: 300}, {0: 17, 1: 18}, {0: 15, 1: 15, 2: 15}, {0: 1500, 1: 1500}])
def test_quotas_add_up(spark, sizes):
    train, val = quotas(spark, sizes)
    total = sum(sizes.values())
    held = -(-total // 5)
    assert sum(train.values()) == total - held
    assert sum(val.values()) == held - -(-held // 2)
    for label, rows_ in sizes.items():
        assert abs(train[label] - rows_ * (total - held) / total) < 1
        assert 0 <= val[label] <= rows_ - train[label]


@pytest.mark.parametrize("sizes", [{0: 5, 1: 5}, {0: 1, 1: 20}, {0: 100, 1: 4}, {0: 3, 1: 3, 2: 3}])
def test_too_few_held_out_rows_are_refused(spark, sizes):
    with pytest.raises(PySparkException, match="Too few rows"):
        quotas(spark, sizes)


def test_shares_by_largest_remainder(spark):
    def shares(total, weights):
        table = spark.createDataFrame(list(weights.items()), "label int, rows long")
        return dict(rows(Sa.shared_out(table, total, "rows", "share"), "label", "share"))

    assert shares(12, {0: 7, 1: 8}) == {0: 6, 1: 6}
    assert shares(3, {0: 5, 1: 5}) == {0: 2, 1: 1}


def test_thousands_of_classes(spark):
    df = spark.range(40000).select(F.col("id").alias("article_id"), (F.col("id") % 2000).cast("int").alias("label"))
    assert counts(Sa.sample_and_split(df), "split") == {("train",): 32000, ("val",): 4000, ("test",): 4000}
    assert Sa.downsample(df, 3).count() == 6000


def test_ranks_are_exact_and_hot_buckets_irrelevant(spark):
    import hashlib

    from prosemill.operators.ranking import ranked_up_to, with_random_order

    df = labelled(spark, 100, 900, 6)
    ordered = with_random_order(df, "article_id", 9)
    takes = spark.createDataFrame([(0, 50), (1, 50)], "label int, take long")
    got = rows(ranked_up_to(ordered, takes, "label", "rank", "article_id"), "article_id", "label", "rank")
    for label, ids in ((0, range(100)), (1, range(100, 1000))):
        order = sorted(ids, key=lambda i: hashlib.md5(f"9:{i}".encode()).hexdigest())
        assert sorted((r, i) for i, l, r in got if l == label) == list(enumerate(order[:50]))


def test_texts_of_the_split(spark):
    split = spark.createDataFrame([(1, 0, "train"), (2, 1, "val")], "article_id long, label int, split string")
    texts = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "article_id long, clean_title string")
    found = Sa.split_texts(split, texts, ["clean_title"])
    assert sorted(rows(found)) == [(1, 0, "train", "a"), (2, 1, "val", "")]
    lost = Sa.split_texts(split, texts.where("article_id <> 2"), ["clean_title"])
    for action in (lost.count, lost.collect, lambda: lost.write.format("noop").mode("overwrite").save()):
        with pytest.raises(PySparkException, match="No article for ids: 1, the smallest is 2"):
            action()
