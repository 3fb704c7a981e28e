import pytest
from pyspark.sql import functions as F

from penprint.operators import splits


@pytest.fixture(scope="module")
def table(spark):
    """Two of three rows in one class."""
    label = F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "mid").otherwise("low")
    df = spark.range(600).select("id", label.alias("label"))
    return df.where((F.col("label") != "low") | (F.col("id") < 100)).withColumn("book", (F.col("id") / 5).cast("int")).cache()


def sizes(df, *keys):
    return {tuple(r[k] for k in keys): r["n"] for r in df.groupBy(*keys).agg(F.count("*").alias("n")).collect()}


def test_balance(table):
    out = splits.balance_classes(table, "label", "id")
    smallest = min(sizes(table, "label").values())
    assert set(sizes(out, "label").values()) == {smallest}
    assert out.select("id").distinct().count() == 3 * smallest
    other = splits.balance_classes(table.repartition(13), "label", "id")
    assert out.exceptAll(other).isEmpty()
    assert not splits.balance_classes(table, "label", "id", seed=7).exceptAll(out).isEmpty()


def test_holdouts(table):
    every = sizes(table, "label")
    out = sizes(splits.stratified_holdout(table, "label", "id", 0.3), "label", "split")
    for (label,), n in every.items():
        assert out[(label, "test")] == -(-3 * n // 10) and out[(label, "test")] + out[(label, "train")] == n
    nested = sizes(splits.nested_holdout(table, "label", "id"), "label", "split")
    assert sum(nested.values()) == table.count()
    assert abs(nested[("big", "train")] / every[("big",)] - 0.8) < 0.02
    assert abs(nested[("big", "valid")] / every[("big",)] - 0.16) < 0.02


def test_folds(table):
    out = sizes(splits.stratified_folds(table, "label", "id", 5), "label", "fold")
    for (label,), n in sizes(table, "label").items():
        per_fold = [out[(label, i)] for i in range(5)]
        assert sum(per_fold) == n and max(per_fold) - min(per_fold) <= 1
    tiny = splits.stratified_folds(table.limit(2), "label", "id", 5)
    assert tiny.count() == 2 and tiny.where("fold is null").isEmpty()


def test_sample(table):
    assert splits.sample_n(table, "id", 17).count() == 17
    assert splits.sample_n(table, "id", 10**6).count() == table.count()


def test_group_folds_and_split(table):
    one_class = table.withColumn("label", F.first("label").over(splits.Window.partitionBy("book").orderBy("id")))
    folds = splits.stratified_group_folds(one_class, "label", "book").cache()
    assert folds.count() == folds.select("book").distinct().count()
    per_fold = sizes(folds.where("label = 'big'"), "fold")
    assert max(per_fold.values()) - min(per_fold.values()) <= 1
    rated = {r["fold"]: r["rmse"] for r in splits.fold_rmse(folds, "label").collect()}
    best = splits.best_fold(folds, "label")
    assert rated[best] == min(rated.values())
    out = splits.apply_split(one_class, folds, "book", best)
    train, test = out.where("split = 'train'"), out.where("split = 'test'")
    assert train.count() + test.count() == table.count()
    splits.assert_disjoint_groups(train, test, "book")
    with pytest.raises(ValueError):
        splits.assert_disjoint_groups(train, train, "book")
    assert splits.rows_in(one_class, test, "book").count() == test.count()
    assert splits.union_corpora(train, test).count() == table.count()
