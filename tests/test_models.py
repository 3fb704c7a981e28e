import inspect
import os

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks import model_queries
from penprint.functions import fixed
from penprint.operators import evaluate, splits, topics
from penprint.operators.catalogue import encode_labels
from penprint.operators.scale import settled
from penprint.operators.vectors import with_class_weights
from penprint.plans import classifiers, jobs, search
from penprint.sources import books
from penprint.sources.tables import read_table
from penprint.streaming import scoring, usage as stream_usage

SHORT = {"vectorizer__min_df": 3, "vectorizer__max_features": 300, "vectorizer__max_df": 0.9, "stats__pos_stats": False}
FAST = {
    "LR": {"model__max_iter": 20}, "SVM": {"model__max_iter": 10, "model__kernel": "linear"}, "MultinomialNB": {},
    "KNN": {"svd__n_components": 10}, "RF": {"svd__n_components": 10, "model__n_estimators": 20, "model__max_depth": 5},
}
INPUTS = classifiers.Inputs(pattern=fixed.ANY_WORD)


@pytest.fixture(scope="module")
def table(spark, small):
    rows = encode_labels(read_table(spark, small, "documents").select("doc_id", "text", "lang"), "lang", "label")
    rows = with_class_weights(rows.withColumn("label", F.col("label").cast("double")), "label")
    return settled(splits.stratified_holdout(rows.repartition(4), "label", "doc_id"))


def weighted_f1(df):
    scored = df.select(F.col("label").cast("int"), F.col("prediction").cast("int"))
    return evaluate.f1_scores(scored).first()["f1_weighted"]


def test_registry():
    assert len(classifiers.CLASSIFIERS) == 10
    assert "BoW stats KNN" in classifiers.CLASSIFIERS and "TF-IDF stats poly RF" in classifiers.CLASSIFIERS
    space = classifiers.CLASSIFIERS["TF-IDF stats poly LR"].space
    assert len(space["model__C"]) == 20 and "svd__n_components" not in space
    assert classifiers.CLASSIFIERS["BoW stats KNN"].space["svd__n_components"] == list(range(20, 201, 20))


@pytest.mark.parametrize("name", sorted(classifiers.CLASSIFIERS))
def test_beats_majority(table, name):
    params = {**SHORT, **FAST[classifiers.CLASSIFIERS[name].kind]}
    model = classifiers.fit_classifier(name, params, INPUTS, table.where("split = 'train'"))
    scored = model.transform(table.where("split = 'test'"))
    majority = table.where("split = 'test'").withColumn("prediction", F.lit(1.0))
    assert scored.count() == majority.count()
    assert weighted_f1(scored) > weighted_f1(majority)


def test_rbf_and_boosting(table):
    params = {**SHORT, "model__kernel": "rbf", "model__max_iter": 10, "model__class_weight": "balanced", "model__C": 10.0}
    part = table.where("split = 'train'")
    scored = classifiers.fit_classifier("BoW stats poly SVM", params, INPUTS, part).transform(table)
    assert scored.select("prediction").distinct().count() > 1
    stats = classifiers.make_stages("BoW stats poly LR", SHORT, INPUTS)[0][1].transform(part)
    boosted = classifiers.boosted("stats", {"iterations": 3, "max_depth": 2}).fit(stats)
    assert boosted.transform(stats).where("prediction is null").isEmpty()


@pytest.mark.parametrize("kind, estimator", [("LR", classifiers.LogisticRegression), ("SVM", classifiers.OneVsRest)])
def test_iterative_fits_read_their_features_from_files(table, monkeypatch, kind, estimator):
    seen, fit = [], estimator.fit
    monkeypatch.setattr(estimator, "fit", lambda self, df, params=None: seen.append(df) or fit(self, df, params))
    part = table.where("split = 'train'").repartition(20)
    held = {**SHORT, "model__C": 0.01, **({"model__kernel": "linear"} if kind == "SVM" else {})}
    model = classifiers.fit_classifier(f"TF-IDF stats poly {kind}", held, INPUTS, part)
    assert len(seen) == 1 and len(seen[0].inputFiles()) > 0 and {"features", "label", "weight"} <= set(seen[0].columns)
    assert not {"text", "tokens", "grams", "stats", "joined"} & set(seen[0].columns)
    assert seen[0].rdd.getNumPartitions() <= part.sparkSession.sparkContext.defaultParallelism
    assert seen[0].count() == part.count() and model.transform(part).where("prediction is null").isEmpty()


def test_save_load_score_and_stream(spark, table, tmp_path):
    part = table.where("split = 'train'")
    model = classifiers.fit_classifier("TF-IDF stats poly MultinomialNB", SHORT, INPUTS, part)
    path = str(tmp_path / "model")
    books.save_model(model, path)
    again = books.load_model(path)
    before = {r["doc_id"]: r["prediction"] for r in model.transform(table).select("doc_id", "prediction").collect()}
    after = {r["doc_id"]: r["prediction"] for r in again.transform(table).select("doc_id", "prediction").collect()}
    assert before == after

    texts = table.select("doc_id", "text", F.lit("kept").alias("note")).orderBy("doc_id").limit(10).coalesce(1)
    books.write_corpus(texts, str(tmp_path / "in"))
    books.score_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), again)
    scored = spark.read.csv(str(tmp_path / "out"), header=True, multiLine=True, escape='"')
    assert scored.columns == ["doc_id", "text", "note", "author"] and scored.count() == 10
    names = jobs.score(texts, again, ["doc_id"])
    assert {r["doc_id"]: r["author"] for r in scored.collect()} == {str(r["doc_id"]): r["name"] for r in names.collect()}

    batch = jobs.score(table, again, ["doc_id"])
    table.select("doc_id", "text").repartition(3).write.parquet(str(tmp_path / "arriving"))
    stream = scoring.text_stream(spark, str(tmp_path / "arriving"), "doc_id bigint, text string", "parquet", "*.parquet")
    run = scoring.score_stream(stream, again, ["doc_id"], str(tmp_path / "rows"), str(tmp_path / "state"), every=None)
    run.awaitTermination()
    streamed = scoring.read_scored(spark, str(tmp_path / "rows"))
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).isEmpty()
    assert batch.where(~F.col("label").between(-1, 9)).isEmpty()


def test_search_and_training(spark, table):
    held = {**SHORT, "vectorizer__min_df": 3, "vectorizer__ngram_range": (1, 1), "model__alpha": 1.0}
    parts = [table.where(F.col("split") == s) for s in ("train", "test")]
    result = jobs.train("BoW stats poly MultinomialNB", parts[0].drop("weight"), parts[1], INPUTS, "doc_id", 3, 2, fixed_params=held)
    assert 0 <= result.best["f1_weighted_std"] <= result.best["f1_weighted_mean"] <= 1
    row = result.record.first()
    assert row["settings"]["n_splits"] == "3" and row["params"]["model"] == {"alpha": "1.0"}
    assert row["test"]["f1_weighted"] == round(result.test["f1_weighted"], 2)


def test_draws():
    import random

    rng = random.Random(1)
    ranges = {**classifiers.BOOST_RANGES, "pick": [1, 2]}
    draws = [search.draw(ranges, rng) for _ in range(200)]
    assert all(100 <= d["iterations"] <= 500 and 0.01 <= d["learning_rate"] <= 0.2 and d["pick"] in (1, 2) for d in draws)
    assert all(2 <= search.draw(classifiers.FOREST_RANGES, rng)["min_samples_split"] <= 200 for _ in range(50))


def test_tune(table):
    folds = splits.stratified_folds(table, "label", "doc_id", 2)
    stats = classifiers.make_stages("BoW stats poly LR", SHORT, INPUTS)[0][1].transform(folds)

    def make(params, n_rows):
        return [], [classifiers.forest({**params, "n_estimators": 5}, featuresCol="stats", labelCol="label")]

    results = search.tune(make, classifiers.FOREST_RANGES, stats, k=2, n_trials=2)
    assert results[0]["f1_weighted_mean"] >= results[1]["f1_weighted_mean"]
    assert search.results_table(results, table.sparkSession).count() == 2


def test_embedding_head(spark):
    centre = F.array(*[F.when(F.col("id") % 4 == i, 1.0).otherwise(0.0) + F.randn(i) * 0.2 for i in range(4)])
    vectors = spark.range(400).select("id", (F.col("id") % 4).cast("double").alias("label"), array_to_vector(centre).alias("vec"))
    table = settled(splits.nested_holdout(settled(vectors), "label", "id"))
    train, valid = table.where("split = 'train'"), table.where("split = 'valid'")
    model = classifiers.embedding_head(train, valid, 4, "vec", hidden=8, rounds=2, iterations=30)
    assert weighted_f1(model.transform(table.where("split = 'test'"))) > 0.9


def test_topics(spark, small):
    rows = spark.createDataFrame(
        [(d, p, w) for d in range(30) for p, w in enumerate((["море", "волна", "лодка"] if d % 2 else ["поле", "пашня", "плуг"]) * 4)],
        "doc int, pos int, lemma string",
    )
    lemmas = rows.groupBy("doc").agg(F.collect_list("lemma").alias("lemmas"))
    listed = topics.build_dictionary(topics.lemma_counts(rows, "doc"), 30)
    vectors, model = topics.count_vectors(lemmas, listed)
    found = topics.dominant_topic(vectors, topics.fit_lda(vectors, 2, passes=5), model.vocabulary, 3).collect()
    assert len(found) == 30 and all(r["probability"] > 0.5 for r in found)
    odd = {r["topic"] for r in found if r["doc"] % 2}
    assert len(odd) == 1 and odd != {r["topic"] for r in found if not r["doc"] % 2}


def test_timely_windows(spark, small, tmp_path):
    """With a delay the windows are kept in the stream's state."""
    events = stream_usage.event_stream(spark, small, "events.parquet")
    paths = str(tmp_path / "out"), str(tmp_path / "state")
    stream_usage.write_updates(stream_usage.timely_windows(events, "40 days"), *paths, every=None).awaitTermination()
    found = stream_usage.latest(spark, paths[0], "window_start").agg(F.sum("n_signups")).first()[0]
    assert found == read_table(spark, small, "events").where("event_type = 'signup'").count()


def test_usage_stream_resumes(spark, small, tmp_path):
    """Files that arrive later, with earlier events too, add to the windows already written."""
    events = read_table(spark, small, "events").orderBy("ts")
    folder, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    os.mkdir(folder)
    n = events.count() // 2
    halves = [events.exceptAll(events.limit(n)), events.limit(n)]  # the later half first
    for half in halves:
        half.coalesce(1).write.mode("append").parquet(folder)
        stream = stream_usage.event_stream(spark, folder)
        stream_usage.write_parts(stream, stream_usage.usage_windows("30 seconds"), out, state, every=None).awaitTermination()
    found = stream_usage.read_windows(spark, out).agg(F.sum("n_signups"), F.sum("n_requests"), F.sum("n_ratings")).first()
    kinds = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert tuple(found) == (kinds["signup"], kinds["click"] + kinds["view"], kinds["purchase"])


@pytest.mark.parametrize("name, target, function", [
    ("svm_rbf_scores", model_queries, "fit_classifier"), ("random_search", model_queries.search, "random_search"), ("training_run", model_queries, "train"),
])
def test_model_queries_ask_for_whole_searches_and_vocabularies(spark, small, monkeypatch, table, name, target, function):
    class Asked(Exception):
        pass

    signature = inspect.signature(getattr(target, function))

    def asked(*args, **options):
        given = signature.bind(*args, **options)
        given.apply_defaults()
        raise Asked(given.arguments)

    monkeypatch.setattr(target, function, asked)
    monkeypatch.setattr(model_queries, "prepared", lambda spark, folder: (table, INPUTS))
    with pytest.raises(Asked) as found:
        getattr(model_queries, name)(spark, small)
    given = found.value.args[0]
    held = given.get("fixed_params") or given.get("params") or {}
    assert not {"vectorizer__max_features", "vectorizer__ngram_range", "model__max_iter"} & set(held)
    if name != "svm_rbf_scores":
        assert (given["n_iter"], given["k"]) == (10, 5)


def test_scored_rows_are_kept_without_their_texts(spark, tmp_path, monkeypatch):
    from checks import model_queries

    rows = [(i, "a long text", "en" if i % 2 else "de", float(i % 2), "train", float(i % 2), [0.25, 0.75]) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, label double, split string, prediction double, probability array<double>")
    df.select("doc_id", "lang").write.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    settled = model_queries.scale.settled
    monkeypatch.setattr(model_queries.scale, "settled", lambda t: kept.append(t.columns) or settled(t))
    out = model_queries.outcome(spark, str(tmp_path), df, probabilities="probability")
    assert sorted(map(tuple, out.collect())) == [(i, "train", i % 2, True, True, True) for i in range(8)]
    assert kept == [["doc_id", "split", "label", "prediction", "probability"]]


def test_folds_share_one_count_of_terms_and_learn_their_own_vocabularies(spark):
    from pyspark.ml.feature import CountVectorizer

    rows = [(i, i % 3, ["a", "b" if i % 2 else "c", f"w{i % 5}", "a"] + (["z"] if i % 3 == 1 else [])) for i in range(30)] + [(30, 0, [])]
    df = spark.createDataFrame(rows, "doc_id int, fold int, grams array<string>")
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    stage = CountVectorizer(inputCol="grams", outputCol="tf", minDF=2.0, maxDF=0.9, vocabSize=search.EVERY_TERM)
    shared = search.counted(stage, df, "fold", sizes)
    assert "grams" not in shared.rows.columns and {str(kind) for kind in shared.facts.schema.types} <= {"int32", "int64"}
    for fold in sizes:
        model = stage.fit(df.where(F.col("fold") != fold))
        want = {r["doc_id"]: sorted((model.vocabulary[i], x) for i, x in zip(r["tf"].indices, r["tf"].values)) for r in model.transform(df).collect()}
        numbers, width = shared.numbers(fold, stage)
        assert width == len(model.vocabulary) and sorted(numbers[numbers >= 0]) == list(range(width))
        got = {r["doc_id"]: r["tf"] for r in search.renumbered(shared.rows, "tf", numbers, width).collect()}
        column = {}
        for r in df.collect():
            assert got[r["doc_id"]].size == width and sorted(got[r["doc_id"]].values) == sorted(x for _, x in want[r["doc_id"]])
            for term, _ in want[r["doc_id"]]:
                column[term] = column.get(term, set(got[r["doc_id"]].indices)) & set(got[r["doc_id"]].indices)
        assert set(column) == set(model.vocabulary) and all(column.values())
    assert search.counted(CountVectorizer(inputCol="grams", outputCol="tf", minDF=99.0), df, "fold", sizes) is None


def test_folds_run_side_by_side_only_as_the_driver_holds_them(table, monkeypatch):
    assert search.side_by_side(table, "label", 1000, 5) == 5
    monkeypatch.setattr(search, "FIT_VECTORS", 1 << 40)
    assert search.side_by_side(table, "label", 1000, 5) == 1


def test_random_search_holds_nothing_returns_every_draw_and_fits_the_best_again(spark, small, monkeypatch, table):
    asked, fits = {}, []

    def found(name, df, inputs, k=5, n_iter=10, **options):
        asked.update(options, k=k, n_iter=n_iter)
        scores = {f"{m}_{s}": 0.5 for m in search.METRICS for s in ("mean", "std")}
        return [{"draw": d, "params": {"model__C": float(d)}, **scores} for d in range(9, -1, -1)]

    class Always:
        def transform(self, df):
            return df.withColumns({"prediction": F.col("label"), "probability": F.array(F.lit(1.0), F.lit(0.0))})

    def fit(name, params, inputs, train):
        fits.append((params, train.count()))
        return Always()

    monkeypatch.setattr(model_queries.search, "random_search", found)
    monkeypatch.setattr(model_queries, "fit_classifier", fit)
    monkeypatch.setattr(model_queries, "prepared", lambda spark, folder: (table.withColumn("split", F.lit("train")), INPUTS))
    rows = model_queries.random_search(spark, small).collect()
    assert sorted(r["draw"] for r in rows) == list(range(10)) and all(r["bounded"] and r["best_first"] for r in rows)
    assert not asked.get("fixed_params") and (asked["k"], asked["n_iter"]) == (5, 10)
    assert fits == [({"model__C": 9.0}, table.count())]
