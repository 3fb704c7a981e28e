import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from penprint.operators import evaluate, inference, profiles, vectors


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 0)] * 1 + [(1, 3)]
    return spark.createDataFrame(rows, "label int, prediction int")


def test_f1(pairs):
    row = evaluate.f1_scores(pairs).first()
    f1 = {0: 10 / 13, 1: 6 / 9, 2: 0.0, 3: 0.0}
    assert math.isclose(row["f1_micro"], 8 / 12)
    assert math.isclose(row["f1_macro"], sum(f1.values()) / 4)
    assert math.isclose(row["f1_weighted"], (7 * f1[0] + 4 * f1[1]) / 12)


def test_report_and_confusion(pairs):
    rows = {r["class"]: r for r in evaluate.class_report(pairs).collect()}
    assert (rows[0]["precision"], rows[0]["recall"], rows[0]["support"]) == (5 / 6, 5 / 7, 7)
    assert (rows[3]["precision"], rows[3]["recall"], rows[3]["support"]) == (0.0, 0.0, 0)
    wide = {r["label"]: r for r in profiles.confusion_wide(pairs, "label", "prediction", [0, 1, 2, 3]).collect()}
    assert wide[0]["0"] == 5 and wide[0]["1"] == 2 and wide[1]["3"] == 1 and wide[2]["2"] == 0


def test_auroc(spark):
    rows = [(0, [0.9, 0.1]), (0, [0.8, 0.2]), (1, [0.3, 0.7]), (1, [0.85, 0.15])]
    df = spark.createDataFrame(rows, "label int, p array<double>")
    got = {r["class"]: r["auroc"] for r in evaluate.multiclass_auroc(df, "label", "p").collect()}

    def area(scores, own):
        points = []
        for i in range(9, -1, -1):
            hits = [s >= i / 9 for s in scores]
            points.append(
                (sum(h and not o for h, o in zip(hits, own)) / own.count(False), sum(h and o for h, o in zip(hits, own)) / own.count(True))
            )
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))

    for c in (0, 1):
        assert math.isclose(got[c], area([p[c] for _, p in rows], [y == c for y, _ in rows]))


def test_reject_and_rank(spark):
    rows = [(1, [0.5, 0.3, 0.2]), (2, [0.1, 0.6, 0.3]), (3, [0.4, 0.4, 0.2])]
    df = spark.createDataFrame(rows, "doc int, probability array<double>")
    assert [r["label_pred"] for r in inference.predict_with_reject(df).orderBy("doc").collect()] == [-1, 1, -1]
    assert [r["label_pred"] for r in inference.predict_with_reject(df, threshold=False).orderBy("doc").collect()] == [0, 1, 0]
    both = inference.predict_authors(df, ["doc"], return_names=True)
    assert both.columns == ["doc", "label", "name"]
    assert inference.predict_authors(df, ["doc"], return_labels=False, return_names=True).columns == ["doc", "name"]
    assert inference.predict_authors(df, ["doc"]).columns == ["doc", "label"]
    ranked = inference.rank_authors(df, "doc").orderBy("doc", "rank").collect()
    assert [r["label"] for r in ranked] == [0, 1, 2, 1, 2, 0, 0, 1, 2]
    best = {r["doc"]: (r["label"], round(r["rest"], 6)) for r in inference.best_and_rest(inference.rank_authors(df, "doc"), "doc").collect()}
    assert best == {1: (0, 0.5), 2: (1, 0.4), 3: (0, 0.6)}


def test_soft_vote(spark):
    a = spark.createDataFrame([(1, [0.6, 0.4]), (2, [0.9, 0.1])], "doc int, probability array<double>")
    b = spark.createDataFrame([(1, [0.1, 0.9]), (2, [0.4, 0.6])], "doc int, probability array<double>")
    got = {r["doc"]: r["prediction"] for r in inference.soft_vote(a, b, "doc").collect()}
    assert got == {1: 1, 2: 0}


def test_run_record(spark, tmp_path):
    params = {"featureunion__embed__text__lemmatize": True, "model__C": 0.1, "model__class_weight": None}
    record = evaluate.run_record(spark, "m", {"seed": 1}, params, {"f1": 0.5}, {"f1": 0.4})
    for _ in range(2):
        evaluate.append_run(record, str(tmp_path / "runs"))
    rows = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert len(rows) == 2
    assert rows[0]["params"] == {"text": {"lemmatize": "True"}, "model": {"C": "0.1", "class_weight": "None"}}


def test_weights_and_clipping(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("b", 1000.0)], "label string, x double")
    weights = {r["label"]: r["weight"] for r in vectors.class_weights(df, "label").collect()}
    assert weights == {"a": 101 / 200, "b": 101 / 2}
    clipped = vectors.clip_upper(df, ["x"], 0.99).agg(F.max("x")).first()[0]
    assert clipped == 99.0


def test_vector_stages(spark):
    rows = [(Vectors.dense([1.0, 2.0, 0.0]),), (Vectors.dense([3.0, 0.0, 1.0]),), (Vectors.sparse(3, {1: 4.0}),)]
    df = spark.createDataFrame(rows, ["v"])
    import numpy as np

    matrix = np.array([r[0].toArray() for r in rows])
    poly = vectors.poly2("v", "p").transform(df).first()["p"].toArray()
    assert sorted(poly) == sorted([1, 2, 0, 1, 4, 0, 2, 0, 0])
    scaled = np.array([r["s"].toArray() for r in vectors.population_scaled(df, "v", "s").collect()])
    assert np.allclose(scaled, matrix / matrix.std(axis=0))
    reduced = vectors.TruncatedSvd(inputCol="v", outputCol="r", k=2).fit(df).transform(df)
    coords = np.array([r["r"].toArray() for r in reduced.collect()])
    _, singular, right = np.linalg.svd(matrix)
    assert np.allclose(np.abs(coords), np.abs(matrix @ right[:2].T), atol=1e-8)
    curve = vectors.explained_curve(df, [1, 2], "v").collect()
    assert 0 < curve[0]["explained"] < curve[1]["explained"] <= 1 + 1e-9
    lifted = np.array([r["f"].toArray() for r in vectors.RandomFourier(inputCol="v", outputCol="f", features=4096, gamma=0.1).transform(df).collect()])
    kernel = np.exp(-0.1 * ((matrix[:, None] - matrix[None]) ** 2).sum(-1))
    assert np.allclose(lifted @ lifted.T, kernel, atol=0.08)
    tf = spark.createDataFrame([(Vectors.dense([2.0, 0.0]),), (Vectors.dense([1.0, 1.0]),)], ["tf"])
    weighted = vectors.SmoothIdf(inputCol="tf", outputCol="w").fit(tf).transform(tf).collect()
    assert np.allclose(weighted[0]["w"].toArray(), [2.0, 0.0])
    assert np.allclose(weighted[1]["w"].toArray(), [1.0, math.log(3 / 2) + 1])
