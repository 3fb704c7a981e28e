import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from penprint.operators import boosting
from penprint.plans import classifiers


def frame(spark, rows, schema):
    """A frame whose ``features`` become vectors."""
    features = F.when(F.col("features").isNotNull(), array_to_vector("features"))
    return spark.createDataFrame(rows, schema).withColumn("features", features)


def made(n=240, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    y = np.where(x[:, 0] > 0.5, 2, np.where(x[:, 1] * x[:, 2] > 0, 1, 0))
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = made()
    rows = [(k, a.tolist(), float(b), 1.0 + k % 2) for k, (a, b) in enumerate(zip(x, y))]
    return frame(spark, rows, "id int, features array<double>, label double, w double").repartition(3)


def plain(x, y, w, borders, rounds, depth, rate, l2):
    """The same trees with every border of every feature tried on all rows at once."""
    k = int(y.max()) + 1
    start = np.log(np.bincount(y, w) / w.sum())
    scores, trees = np.tile(start, (len(y), 1)), []
    for _ in range(rounds):
        p = boosting.softmax(scores)
        g, h = (p - np.eye(k)[y]) * w[:, None], 2 * p * (1 - p) * w[:, None]
        leaf, chosen = np.zeros(len(y), int), []
        for level in range(depth):
            best = (0.0, None)
            for f, border in enumerate(borders):
                for b, value in enumerate(border):
                    right = x[:, f] > value
                    gain = 0.0
                    for node in range(1 << level):
                        for side in (right, ~right, np.ones(len(y), bool)):
                            at = (leaf == node) & side
                            part = (g[at].sum(0) ** 2 / (h[at].sum(0) + l2)).sum()
                            gain += -part if side.all() else part
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, b))
            chosen.append(best[1])
            leaf |= (x[:, best[1][0]] > borders[best[1][0]][best[1][1]]).astype(int) << level
        values = np.array([[-rate * g[leaf == n, c].sum() / (h[leaf == n, c].sum() + l2) for c in range(k)] for n in range(1 << depth)])
        scores = scores + values[leaf]
        trees.append((chosen, values))
    return trees


def test_trees_equal_trying_every_border(table):
    model = boosting.SoftmaxBoosting(iterations=3, maxDepth=2, learningRate=0.3, l2=1.5, bins=6, weightCol="w").fit(table)
    rows = sorted(table.collect(), key=lambda r: r["id"])
    x, y, w = np.array([r["features"].toArray() for r in rows]), np.array([int(r["label"]) for r in rows]), np.array([r["w"] for r in rows])
    for tree, (chosen, values) in zip(model.trees, plain(x, y, w, model.borders, 3, 2, 0.3, 1.5), strict=True):
        assert list(zip(tree.features, tree.bins)) == chosen and np.allclose(tree.values, values)


def test_loss_never_rises_and_new_rows_are_told_apart(spark, table, tmp_path):
    model = boosting.SoftmaxBoosting(iterations=18, maxDepth=3, learningRate=0.2, l2=0.16).fit(table)
    assert len(model.trees) == 18 and all(b <= a for a, b in zip(model.losses, model.losses[1:]))
    x, y = made(seed=6)
    new = frame(spark, [(a.tolist(), int(b)) for a, b in zip(x, y)], "features array<double>, y int")
    scored = model.transform(new).collect()
    assert sum(r["prediction"] == r["y"] for r in scored) > 1.4 * np.bincount(y).max()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] == int(np.argmax(r["probability"])) for r in scored)
    model.write().save(f"{tmp_path}/m")
    again = boosting.SoftmaxBoostingModel.load(f"{tmp_path}/m")
    assert [r["probability"] for r in again.transform(new).collect()] == [r["probability"] for r in scored]
    assert again.losses == model.losses


def test_refreshed_scores_change_nothing(table, monkeypatch):
    one = boosting.SoftmaxBoosting(iterations=5, maxDepth=2).fit(table)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "SUMS_BYTES", 1)
    two = boosting.SoftmaxBoosting(iterations=5, maxDepth=2).fit(table)
    assert all(a.features == b.features and a.bins == b.bins and np.allclose(a.values, b.values) for a, b in zip(one.trees, two.trees, strict=True))


def test_bins_of_odd_values():
    codes = boosting.coded(np.array([[np.nan, 1.0], [-5.0, 2.0], [0.0, 3.0], [9.0, 2.5]]), [np.array([0.0, 3.0]), np.array([2.0])])
    assert codes.tolist() == [[0, 0], [0, 0], [0, 1], [2, 1]]


def test_constant_features_and_missing_labels(spark):
    rows = [([1.0], 1.0), ([1.0], 3.0), ([1.0], None), (None, 1.0)]
    df = frame(spark, rows, "features array<double>, label double")
    model = classifiers.softmax_boosted("features", {"iterations": 3}).fit(df)
    assert model.trees == [] and len(model.start) == 4
    out = model.transform(df).collect()
    assert [[round(v, 3) for v in r["probability"]] for r in out[:3]] == [[0, 0.5, 0, 0.5]] * 3
    assert out[3]["probability"] is None and out[3]["prediction"] is None
    with pytest.raises(ValueError):
        classifiers.softmax_boosted("features").fit(df.limit(0))
