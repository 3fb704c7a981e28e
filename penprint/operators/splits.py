"""Balanced samples, folds and train/test splits that partitioning cannot change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.operators.scale import (
    hash_cutoffs, hash_order, lookup_join, settled, size_then_hash_rank,
)


def _with_cutoffs(df: DataFrame, label: str, doc: str, ranks: Column, seed: int) -> DataFrame:
    """Rows with their hash ``_h`` and the array ``_cuts`` of their class."""
    hashed = df.withColumn("_h", hash_order(doc, seed))
    cuts = hash_cutoffs(hashed, [label], "_h", ranks)
    per_class = settled(
        cuts.groupBy(label).agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "cutoff"))).alias("_cuts")
        )
    )
    return lookup_join(hashed, per_class, [label], "left", salt_on=["_h"])


def balance_classes(df: DataFrame, label: str, doc: str, seed: int = 42) -> DataFrame:
    """As many random rows of each class as the smallest class has.

    The hash at the wanted rank is found per class, then rows are filtered; the
    texts are never sorted or shuffled.
    """
    rows = _with_cutoffs(df, label, doc, F.array("n_min"), seed)
    return rows.where(F.col("_h") <= F.col("_cuts")[0]).drop("_h", "_cuts")


def stratified_holdout(
    df: DataFrame, label: str, doc: str, test: float = 0.3, seed: int = 42,
    names: tuple[str, str] = ("train", "test"), out: str = "split",
) -> DataFrame:
    """Mark the same share of every class as test rows (rounded up per class)."""
    ranks = F.array(F.ceil(F.col("n") * F.lit(float(test))))
    rows = _with_cutoffs(df, label, doc, ranks, seed)
    held = F.coalesce(F.col("_h") <= F.col("_cuts")[0], F.lit(False))
    train, held_out = names
    return rows.withColumn(out, F.when(held, F.lit(held_out)).otherwise(F.lit(train))).drop("_h", "_cuts")


def nested_holdout(
    df: DataFrame, label: str, doc: str, share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Train, validation and test: a share is held out, and that share of it is test.

    With 0.2 this gives 80 / 16 / 4 per class.
    """
    held = F.ceil(F.col("n") * F.lit(float(share)))
    ranks = F.array(F.ceil(held * F.lit(float(share))), held)
    rows = _with_cutoffs(df, label, doc, ranks, seed)
    split = (
        F.when(F.col("_h") <= F.col("_cuts")[0], F.lit("test"))
        .when(F.col("_h") <= F.col("_cuts")[1], F.lit("valid"))
        .otherwise(F.lit("train"))
    )
    return rows.withColumn("split", split).drop("_h", "_cuts")


def stratified_folds(df: DataFrame, label: str, doc: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Shuffled folds of equal size within every class."""
    ranks = F.array(*[F.floor(F.col("n") * F.lit(i) / F.lit(k)) for i in range(1, k)])
    rows = _with_cutoffs(df, label, doc, ranks, seed)
    passed = [
        F.coalesce((F.col("_h") > F.col("_cuts")[i]), F.lit(True)).cast("int") for i in range(k - 1)
    ]
    return rows.withColumn("fold", reduce(lambda a, b: a + b, passed)).drop("_h", "_cuts")


def sample_n(df: DataFrame, doc: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` random rows, or all of them."""
    rows = _with_cutoffs(df.withColumn("_all", F.lit(0)), "_all", doc, F.array(F.least(F.col("n"), F.lit(n))), seed)
    return rows.where(F.col("_h") <= F.col("_cuts")[0]).drop("_h", "_cuts", "_all")


def stratified_group_folds(
    df: DataFrame, label: str, group: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """A fold per group: (label, group, n, fold), class shares kept alike.

    Groups of a class are dealt to the folds back and forth, largest first. A
    group with rows of several classes is dealt with its main class, so it still
    has one fold.
    """
    counts = df.groupBy(label, group).agg(F.count("*").alias("n"))
    main = F.max_by(label, F.struct("n", label)).alias(label)
    groups = counts.groupBy(group).agg(main, F.sum("n").alias("n"))
    ranked = size_then_hash_rank(groups.withColumn("_h", hash_order(group, seed)), [label], "n", "_h")
    turn, seat = F.floor((F.col("rank") - 1) / k), (F.col("rank") - 1) % k
    fold = F.when(turn % 2 == 0, seat).otherwise(k - 1 - seat).cast("int")
    return ranked.withColumn("fold", fold).drop("_h", "rank")


def fold_rmse(fold_groups: DataFrame, label: str, k: int = 5) -> DataFrame:
    """Per fold: the RMSE between class percentages of train and test rows."""
    counts = fold_groups.groupBy("fold", label).agg(F.sum("n").alias("n_test"))
    classes = counts.groupBy(label).agg(F.sum("n_test").alias("n_class"))
    grid = classes.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    both = grid.join(counts, ["fold", label], "left").fillna(0, ["n_test"])
    both = both.withColumn("n_train", F.col("n_class") - F.col("n_test"))
    fold = Window.partitionBy("fold")
    gap = 100.0 * F.col("n_train") / F.sum("n_train").over(fold) - 100.0 * F.col(
        "n_test"
    ) / F.sum("n_test").over(fold)
    return both.withColumn("gap", gap).groupBy("fold").agg(
        F.sqrt(F.avg(F.col("gap") * F.col("gap"))).alias("rmse")
    )


def best_fold(fold_groups: DataFrame, label: str, k: int = 5) -> int:
    """The fold whose train and test classes are most alike (the first on a tie)."""
    rated = fold_rmse(fold_groups, label, k).select(F.round("rmse", 9).alias("rmse"), "fold")
    return rated.agg(F.min(F.struct("rmse", "fold"))["fold"].alias("fold")).first()["fold"]


def apply_split(df: DataFrame, fold_groups: DataFrame, group: str, fold: int) -> DataFrame:
    """Mark the rows of one fold's groups as test, all others as train."""
    folds = fold_groups.select(group, "fold")
    split = F.when(F.col("fold") == fold, F.lit("test")).otherwise(F.lit("train"))
    return lookup_join(df, folds, [group]).withColumn("split", split).drop("fold")


def shared_groups(train: DataFrame, test: DataFrame, group: str) -> DataFrame:
    """Groups on both sides of a split."""
    return train.select(group).intersect(test.select(group))


def assert_disjoint_groups(train: DataFrame, test: DataFrame, group: str) -> None:
    if not shared_groups(train, test, group).isEmpty():
        raise ValueError(f"train and test share values of {group}")


def rows_in(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return lookup_join(df, listed.select(key).distinct(), [key], "left_semi")


def union_corpora(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
