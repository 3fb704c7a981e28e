import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from penprint.operators import head


def made(n, seed=3):
    """Two intertwined classes, one of them rare, that no plane tells apart."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 2))
    return x, ((x[:, 0] * x[:, 1] > 0.15)).astype(int)


def frame(spark, x, y, valid=None):
    rows = [(k, None if a is None else list(map(float, a)), b, bool(valid[k]) if valid is not None else None) for k, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([(k, a, None if b is None else float(b), v) for k, a, b, v in rows], "id int, v array<double>, label double, held boolean")
    return df.withColumn("features", F.when(F.col("v").isNotNull(), array_to_vector("v")))


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    layers = [rng.normal(size=s) for s in ((3, 4), (4,), (4, 3), (3,))]
    x, labels, weights = rng.normal(size=(6, 3)), rng.integers(0, 3, 6), rng.uniform(0.5, 2, 6)
    mask = head.kept_units(np.arange(6), 4, 1, 0.3)
    shapes = [a.shape for a in layers]
    flat, grads = head.unrolled(layers), head.unrolled(head.loss_and_gradients(layers, x, labels, weights, mask)[1])
    for k in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        slope = [head.loss_and_gradients(head.rolled(f, shapes), x, labels, weights, mask)[0] for f in (up, down)]
        assert abs((slope[0] - slope[1]) / 2e-6 - grads[k]) < 1e-4


def test_dropout_keeps_the_mean_and_depends_on_the_row_alone():
    keys = np.arange(-50, 50)
    mask = head.kept_units(keys, 300, 2, 0.25)
    assert abs(mask.mean() - 1) < 0.02 and set(np.unique(mask.round(6))) == {0.0, round(1 / 0.75, 6)}
    assert (head.kept_units(keys[::-1], 300, 2, 0.25) == mask[::-1]).all() and (head.kept_units(keys, 300, 3, 0.25) != mask).any()


def test_one_pass_equals_all_rows_at_once(spark, monkeypatch):
    monkeypatch.setattr(head, "BLOCK", 7)
    x, y = made(40)
    stage = head.ReluHead(hidden=5)
    state, width, classes = stage._state(frame(spark, x, y))
    layers = [np.random.default_rng(1).normal(size=s) for s in ((width, 5), (5,), (5, classes), (classes,))]
    loss, weight, flat = head.gradient_pass(state.repartition(4), layers, 0, 0.0)
    per = {c: 40 / (2 * (y == c).sum()) for c in (0, 1)}
    w = np.array([per[c] for c in y])
    want, grads = head.loss_and_gradients(layers, x, y, w, np.ones((40, 5)))
    assert abs(loss - want) < 1e-9 and abs(weight - w.sum()) < 1e-9 and np.allclose(flat, head.unrolled(grads))
    assert abs(head.mean_loss(state, layers) - want / w.sum()) < 1e-9


def test_learns_keeps_the_best_epoch_and_can_be_saved(spark, tmp_path):
    x, y = made(300)
    valid = np.arange(300) % 4 == 0
    df = frame(spark, x, y, valid)
    stage = head.ReluHead(hidden=24, epochs=12, batches=2, rate=0.05, dropout=0.0, validCol="held")
    model = stage.fit(df)
    out = model.transform(df).where("held").collect()
    right = {c: np.mean([r["prediction"] == c for r in out if r["label"] == c]) for c in (0, 1)}
    assert min(right.values()) > 0.75
    losses = [v for _, v in model.losses]
    state, _, _ = stage._state(df)
    assert len(losses) == 12 and abs(head.mean_loss(state.where("valid"), model.layers) - min(losses)) < 1e-9
    model.write().save(f"{tmp_path}/m")
    again = head.ReluHeadModel.load(f"{tmp_path}/m")
    assert [r["probability"] for r in again.transform(df).where("held").collect()] == [r["probability"] for r in out]


def test_missing_rows(spark):
    df = frame(spark, [[0.0, 1.0], [1.0, 0.0], None, [1.0, 1.0]], [0, 1, 1, None])
    model = head.ReluHead(hidden=3, epochs=1, batches=1).fit(df)
    out = model.transform(df).orderBy("id").collect()
    assert out[2]["prediction"] is None and out[3]["prediction"] is not None and math.isnan(model.losses[0][1])
    with pytest.raises(ValueError):
        head.ReluHead().fit(df.limit(0))
