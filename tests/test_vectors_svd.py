import tracemalloc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import model_queries
from penprint.functions import fixed
from penprint.operators import blocks, vectors
from penprint.operators.vectors import TruncatedSvd, count_stage
from penprint.plans import classifiers
from penprint.sources import books
from penprint.sources.tables import read_table


def test_svd_matches_numpy_and_is_saved(spark, tmp_path):
    rng = np.random.default_rng(1)
    matrix = (rng.random((60, 5000)) < 0.01) * rng.normal(size=(60, 5000)) + np.outer(rng.normal(size=60), rng.normal(size=5000)) * 0.1
    matrix[:, 3000:] = 0
    rows = [(i, Vectors.sparse(5000, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) if i % 2 else Vectors.dense(r)) for i, r in enumerate(matrix)]
    df = spark.createDataFrame(rows, ["id", "v"]).repartition(3)
    model = TruncatedSvd(inputCol="v", outputCol="c", k=4, rounds=12).fit(df)
    want = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.values, want[1][:4], rtol=1e-3) and np.allclose(model.vectors.T @ model.vectors, np.eye(4), atol=1e-9)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    for stage in (model, again):
        got = {r["id"]: r["c"] for r in stage.transform(df).select("id", vector_to_array("c").alias("c")).collect()}
        assert np.allclose(np.array([got[i] for i in range(60)]), matrix @ model.vectors)


def test_variance_curve_is_that_of_all_columns_of_wide_rows(spark):
    rng = np.random.default_rng(5)
    matrix = np.zeros((50, 70000))
    matrix[:, ::700] = (rng.random((50, 100)) < 0.3) * rng.integers(1, 9, (50, 100))
    df = spark.createDataFrame([(Vectors.sparse(70000, [(int(j), float(r[j])) for j in np.flatnonzero(r)]),) for r in matrix], ["v"])
    values = np.linalg.svd((matrix - matrix.mean(axis=0))[:, ::700], compute_uv=False) ** 2
    got = [r["explained"] for r in vectors.explained_curve(df, [1, 3, 10], "v").orderBy("k").collect()]
    assert np.allclose(got, [values[:k].sum() / values.sum() for k in (1, 3, 10)], atol=1e-3)


def test_variance_query_takes_the_whole_bag_of_words(spark, small, monkeypatch):
    seen = {}

    def curve(df, ks, source):
        out = vectors.explained_curve(df, ks, source)
        seen.update(rows=np.array([r[0].toArray() for r in df.select(source).collect()]), shares={r["k"]: r["explained"] for r in out.collect()})
        return out

    monkeypatch.setattr(model_queries, "explained_curve", curve)
    assert [tuple(r) for r in model_queries.pca_variance(spark, small).orderBy("k").collect()] == [(k, True) for k in (10, 20, 30, 40, 50)]
    values = np.linalg.svd(seen["rows"] - seen["rows"].mean(axis=0), compute_uv=False) ** 2
    assert seen["rows"].shape[1] > 50 and max(seen["shares"]) == 500
    for k, share in seen["shares"].items():
        assert abs(share - values[:k].sum() / values.sum()) < 1e-3


@pytest.mark.parametrize("max_df", [0.5, 0.75, 1.0])
@pytest.mark.parametrize("min_df", [1, 2, 0.5, 1.0])
def test_document_frequencies_are_shares_or_counts(spark, min_df, max_df):
    rows = [(["a", "b"],), (["a", "b"],), (["a", "c"],), (["a", "d", "b"],)]
    df = spark.createDataFrame(rows, "t array<string>")
    counts = {"a": 4, "b": 3, "c": 1, "d": 1}
    low = 4 * min_df if isinstance(min_df, float) else min_df
    want = {t for t, n in counts.items() if low <= n <= 4 * max_df}
    if 4 * max_df < low:
        return
    assert set(count_stage("t", "v", min_df, max_df, n_docs=4).fit(df).vocabulary) == want
    assert set(count_stage("t", "v", 1, 3).fit(df).vocabulary) == {"b", "c", "d"}


def test_neighbour_pipeline_with_string_ids_is_saved(spark, small, tmp_path):
    rows = read_table(spark, small, "documents").limit(60)
    rows = rows.select(F.concat(F.lit("d#"), "doc_id").alias("doc_id"), "text", (F.col("doc_id") % 2).cast("double").alias("label"))
    rows = rows.repartition(4).cache()
    params = {"vectorizer__min_df": 3, "vectorizer__max_df": 0.9, "stats__pos_stats": False, "svd__n_components": 5}
    model = classifiers.fit_classifier("BoW stats KNN", params, classifiers.Inputs(pattern=fixed.ANY_WORD), rows)
    books.save_model(model, str(tmp_path / "knn"))
    again = books.load_model(str(tmp_path / "knn"))
    first, second = ({r["doc_id"]: r["prediction"] for r in m.transform(rows).select("doc_id", "prediction").collect()} for m in (model, again))
    assert first == second and len(first) == 60 and None not in first.values()


def test_random_features_of_wide_rows_hold_neither_the_rows_nor_the_directions_whole(spark):
    rng = np.random.default_rng(3)
    matrix = (rng.random((40, 20000)) < 0.01) * rng.normal(size=(40, 20000))
    rows = [(i, Vectors.sparse(20000, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) if i % 4 else Vectors.dense(r)) for i, r in enumerate(matrix)]
    rows.append((40, Vectors.sparse(20000, [])))
    stage = vectors.RandomFourier(inputCol="v", outputCol="f", features=16, gamma=0.01, seed=7)
    got = {r["id"]: r["f"].toArray() for r in stage.transform(spark.createDataFrame(rows, ["id", "v"]).repartition(3)).collect()}
    draws = np.random.default_rng(7)
    weights, shift = draws.normal(0.0, np.sqrt(0.02), (20000, 16)), draws.uniform(0.0, 2.0 * np.pi, 16)
    want = np.sqrt(2.0 / 16) * np.cos(np.vstack([matrix, np.zeros(20000)]) @ weights + shift)
    assert np.allclose(np.array([got[i] for i in range(41)]), want)

    wide = [(np.sort(rng.choice(300_000, 200, replace=False)), rng.random(200)) for _ in range(50)]
    tracemalloc.start()
    vectors.lifted_rows(wide, 300_000, 256, 0.01, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # the directions alone have 614 MB


def test_directions_lie_in_several_files_and_are_not_collected(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FILE", 8 * 14 * 500)  # ten files of 500 input columns
    monkeypatch.setattr(blocks, "ENTRIES", 300)  # and several rounds of rows in a task
    rng = np.random.default_rng(1)
    matrix = (rng.random((60, 5000)) < 0.02) * rng.integers(1, 5, (60, 5000)) + np.outer(rng.random(60) < 0.5, rng.random(5000) < 0.1)
    matrix[:, 1500:2100] = 0  # one file has no entries
    df = spark.createDataFrame([(i, Vectors.sparse(5000, [(int(j), float(r[j])) for j in np.flatnonzero(r)])) for i, r in enumerate(matrix)], ["id", "v"]).repartition(3)
    # single step against numpy
    block = blocks.drawn(spark, 5000, 14, 3)
    assert len(block.numbers) == 10
    upper, _, _ = blocks.facts(spark, block)
    block = blocks.orthonormal(block, upper)
    start = block.whole()
    assert np.allclose(start.T @ start, np.eye(14), atol=1e-12)
    assert np.allclose(blocks.products(df, "v", block).whole(), matrix.T @ (matrix @ start))
    mean = matrix.mean(axis=0)
    centred = matrix - mean
    less = 60 * (mean @ start)
    assert np.allclose(blocks.products(df, "v", block, mean, less).whole(), centred.T @ (centred @ start))
    # the fit, with the driver never holding a block
    monkeypatch.setattr(blocks.Block, "whole", lambda self: pytest.fail("collected"))
    model = TruncatedSvd(inputCol="v", outputCol="c", k=4, rounds=30).fit(df)
    got = {r["id"]: r["c"] for r in model.transform(df).select("id", vector_to_array("c").alias("c")).collect()}
    left, values, _ = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.values, values[:4], rtol=1e-4)
    assert np.allclose(np.abs([got[i] for i in range(60)])[:, 0], np.abs(left[:, 0] * values[0]), rtol=1e-3, atol=1e-3)


def test_more_components_than_the_rows_span(spark):
    rows = [(i, Vectors.sparse(40, {0: 1.0 + i, 3: 2.0})) for i in range(5)] + [(5, Vectors.sparse(40, {}))]
    model = TruncatedSvd(inputCol="v", outputCol="c", k=4).fit(spark.createDataFrame(rows, ["id", "v"]))
    matrix = np.array([v.toArray() for _, v in rows])
    assert model.vectors.shape == (40, 4) and np.allclose(model.values, np.linalg.svd(matrix, compute_uv=False)[:4], atol=1e-5)
    zeros = spark.createDataFrame([(0, Vectors.sparse(40, {})), (1, Vectors.dense([0.0] * 40))], ["id", "v"])
    model = TruncatedSvd(inputCol="v", outputCol="c", k=4).fit(zeros)
    assert [r["c"].toArray().tolist() for r in model.transform(zeros).collect()] == [[0.0] * 4] * 2


def test_rows_are_read_once_for_all_rounds_and_never_shuffled(spark):
    rng = np.random.default_rng(2)
    matrix = (rng.random((50, 300)) < 0.1) * rng.choice([1.0, 2.5, 300.0, 1e-9], (50, 300))
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(i):
        read.add(1)
        return i

    df = spark.createDataFrame([(i, Vectors.sparse(300, [(int(j), float(r[j])) for j in np.flatnonzero(r)])) for i, r in enumerate(matrix)], ["id", "v"]).repartition(2)
    df = df.withColumn("id", seen("id")).where("id >= 0")
    model = TruncatedSvd(inputCol="v", outputCol="c", k=3, rounds=40).fit(df)
    assert read.value < 3 * 50  # the width, and the chunks
    assert np.allclose(model.values, np.linalg.svd(matrix, compute_uv=False)[:3], rtol=1e-6)
