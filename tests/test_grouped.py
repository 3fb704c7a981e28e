import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from penprint.operators import grouped, splits


def books(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for g in range(n):
        main = rng.choices("abc", [5, 3, 1])[0]
        rows += [(f"g{g}", rng.choice([main, main, main, rng.choice("abc")])) for _ in range(rng.choice([1, 2, 5, 5, 20]))]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(books(4), "book string, label string").repartition(5)


def plain(counts, k):
    """The rule, one group and one fold at a time."""
    totals, folds, out = counts.sum(0), np.zeros((k, counts.shape[1])), []
    for add in counts:
        best = None
        for i in range(k):
            folds[i] += add
            value = round(float(np.mean([np.std(folds[:, c] / totals[c]) for c in range(counts.shape[1])])), 12)
            folds[i] -= add
            key = (value, folds[i].sum(), i)
            best = key if best is None or key < best else best
        folds[best[2]] += add
        out.append(best[2])
    return out


def test_deal_equals_the_rule_step_by_step():
    rng = np.random.default_rng(1)
    for k in (2, 3, 5):
        counts = rng.integers(0, 9, (40, 3)).astype(float)
        out, folds = grouped.dealt(counts, k, counts.sum(0))
        assert out.tolist() == plain(counts, k) and (folds.sum(0) == counts.sum(0)).all()


def gap(df, folds):
    """Mean deviation of the class shares over the folds."""
    rows = df.join(folds.select("book", "fold"), "book").groupBy("fold", "label").count().toPandas()
    shares = rows.pivot(index="fold", columns="label", values="count").fillna(0).to_numpy()
    return (shares / shares.sum(0)).std(0).mean()


def test_shares_differ_no_more_than_by_dealing_in_turn(spark, table):
    folds = grouped.spread_group_folds(table, "label", "book", 5)
    assert folds.count() == 90 and {r["fold"] for r in folds.collect()} == set(range(5))
    assert gap(table, folds) <= gap(table, splits.stratified_group_folds(table, "label", "book", 5))
    again = grouped.spread_group_folds(table.repartition(2), "label", "book", 5)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, again.collect()))


def test_shards_stay_alike(spark, table, monkeypatch):
    whole = gap(table, grouped.spread_group_folds(table, "label", "book", 3))
    monkeypatch.setattr(grouped, "SHARD", 20)
    folds = grouped.spread_group_folds(table, "label", "book", 3)
    assert folds.count() == 90 and folds.select("book").distinct().count() == 90
    assert whole < gap(table, folds) < 0.05  # shards of some 18 groups leave remainders that one deal does not


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 1), ("y", 2)], "book string, label int")
    assert sorted((r["book"], r["n"]) for r in grouped.spread_group_folds(df, "label", "book", 2).collect()) == [("x", 1), ("y", 1)]
    assert grouped.spread_group_folds(df.limit(0), "label", "book", 2).count() == 0
    assert df.where(F.lit(False)).count() == 0
