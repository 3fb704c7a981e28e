"""Registered queries that fit models or run streams."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators import boosting, catalogue, chunking, head, inference, lexicon, pos, pruning, scale, splits, terms, topics
from penprint.operators.extractor import stat_columns
from penprint.operators.vectors import TruncatedSvd, count_stage, explained_curve, with_class_weights
from penprint.plans import classifiers, guided, search
from penprint.plans.classifiers import Inputs, fit_classifier
from penprint.plans.jobs import train
from penprint.session import run_folder
from penprint.sources.tables import read_table
from penprint.streaming import scoring as stream_scoring
from penprint.streaming import usage as stream_usage

from checks.workload import CONTENT, STOP, WORD, author_number, docs, query
from penprint.functions import text as T


@query
def fragments(spark, folder):
    raw = docs(spark, folder).select(
        F.col("doc_id").alias("book"), F.concat(T.author_prefix(author_number()), "text").alias("value")
    )
    return chunking.build_corpus(raw, 1000)


def prepared(spark, folder) -> tuple[DataFrame, Inputs]:
    """Labelled documents with their statistics, computed once before any fit."""
    table = docs(spark, folder)
    words = lexicon.synthetic_lexicon(table)
    path = run_folder(spark, "lexicon")
    words.write.parquet(path)
    coded = catalogue.encode_labels(table.select("doc_id", "text", "lang"), "lang", "label")
    rows = pos.text_stats(coded, "doc_id", lexicon=words, pattern=WORD)
    rows = rows.withColumn("label", F.col("label").cast("double")).drop("lang")
    weighted = scale.stored(with_class_weights(rows, "label"), "weighted")
    return scale.stored(splits.stratified_holdout(weighted, "label", "doc_id"), "prepared"), Inputs(pattern=WORD, stopwords=tuple(STOP), lexicon_path=path)


SHORT = {"vectorizer__min_df": 5, "vectorizer__max_df": 0.75, "text__lemmatize": False}


def fitted(spark, folder, name: str, **params) -> DataFrame:
    """All documents scored by a classifier fitted on the train part."""
    table, inputs = prepared(spark, folder)
    part = table.where("split = 'train'")
    return fit_classifier(name, {**SHORT, **params}, inputs, part).transform(table)


def outcome(spark, folder, df: DataFrame, label: str = "label", table: str = "documents", name: str = "lang", probabilities: str | None = None) -> DataFrame:
    """What must hold of scored rows: the split and label of every row, a prediction among the known labels,
    probabilities that are shares of one, and at least as many right answers as the most frequent label gives."""
    key = "vec_id" if table == "embeddings" else "doc_id"
    df = scale.settled(df.select(key, "split", label, "prediction", *([probabilities] if probabilities else [])))
    right = F.avg((F.col(label) == F.col("prediction")).cast("int")).alias("right")
    most = df.groupBy(label).count().agg(F.max("count") / F.sum("count")).first()[0]
    learned = df.agg(right).first()["right"] >= most
    known = read_table(spark, folder, table).agg(F.count_distinct(name)).first()[0]
    bounded = F.lit(True)
    if probabilities:
        p = F.col(probabilities) if dict(df.dtypes)[probabilities].startswith("array") else vector_to_array(probabilities)
        bounded = F.forall(p, lambda x: (x >= 0) & (x <= 1 + 1e-9)) & (F.abs(F.aggregate(p, F.lit(0.0), lambda s, x: s + x) - 1) < 1e-6)
    return df.select(
        key, "split", F.col(label).cast("int").alias("label"),
        F.coalesce(F.col("prediction").between(0, known - 1) & (F.col("prediction") == F.floor("prediction")), F.lit(False)).alias("known"),
        bounded.alias("bounded"), F.lit(bool(learned)).alias("learned"),
    )


@query
def lr_scores(spark, folder):
    scored = fitted(spark, folder, "TF-IDF stats poly LR", text__lemmatize=True, model__C=10.0, model__class_weight="balanced")
    return outcome(spark, folder, scored, probabilities="probability")


@query
def nb_scores(spark, folder):
    scored = fitted(spark, folder, "BoW stats poly MultinomialNB", model__alpha=1.0)
    return outcome(spark, folder, scored, probabilities="probability")


@query
def svm_scores(spark, folder):
    return outcome(spark, folder, fitted(spark, folder, "TF-IDF stats poly SVM", model__kernel="linear"))


@query
def svm_rbf_scores(spark, folder):
    scored = fitted(spark, folder, "TF-IDF stats poly SVM", model__kernel="rbf")
    return outcome(spark, folder, scored)


@query
def knn_scores(spark, folder):
    scored = fitted(
        spark, folder, "TF-IDF stats KNN", svd__n_components=40, model__n_neighbors=10, model__weights="distance"
    )
    return outcome(spark, folder, scored)


@query
def rf_scores(spark, folder):
    scored = fitted(
        spark, folder, "BoW stats poly RF", svd__n_components=40, model__n_estimators=100, model__max_depth=10
    )
    return outcome(spark, folder, scored, probabilities="probability")


def _bow(spark, folder) -> DataFrame:
    rows = docs(spark, folder).select("doc_id", "lang", terms.vector_tokens("text").alias("tokens"))
    coded = catalogue.encode_labels(scale.balanced(rows), "lang", "label")
    return scale.stored(count_stage("tokens", "bow", 3, 0.5).fit(coded).transform(coded).drop("tokens"), "bow")


@query
def default_vocabulary(spark, folder):
    """Sizes per document frequency of the vocabulary that a classifier with default settings learns."""
    rows = scale.settled(docs(spark, folder).select("doc_id", terms.vector_tokens("text").alias("tokens")))
    spec = classifiers.CLASSIFIERS["BoW stats poly MultinomialNB"]
    stages = classifiers.embedding_stages(spec, {"vectorizer": {}, "svd": {}}, "embed", rows.count())
    model = Pipeline(stages=stages[:2]).fit(rows).stages[1]
    learned = spark.createDataFrame([(t,) for t in model.vocabulary], "term string")
    df = rows.select("doc_id", F.explode("tokens").alias("term")).distinct().groupBy("term").agg(F.count("*").alias("df"))
    band = F.when(F.col("df") == 1, "1").when(F.col("df") < 5, "2-4").when(F.col("df") < 10, "5-9").otherwise("10+")
    return learned.join(df, "term").groupBy(band.alias("band")).agg(F.count("*").alias("n_terms"))


@query
def gbt_scores(spark, folder):
    rows = _bow(spark, folder)
    reduced = TruncatedSvd(inputCol="bow", outputCol="comps", k=50).fit(rows).transform(rows).drop("bow")
    table = splits.stratified_holdout(reduced, "lang", "doc_id").withColumn("label", F.col("label").cast("double"))
    table = scale.stored(table, "reduced")
    model = classifiers.boosted("comps", {"max_depth": 3}).fit(table.where("split = 'train'"))
    return outcome(spark, folder, model.transform(table))


def _mark_features(spark, folder) -> DataFrame:
    """Documents with counts of marks and words as a vector, and the language as label."""
    table = scale.balanced(docs(spark, folder)).select("doc_id", "lang", "text")
    counts = [F.regexp_count("text", F.lit(p)).cast("double") for p in (r"[.]", r"[,]", r"[!?]", r"\n", r"\p{Lu}", r"[^\x00-\x7F]", r"\p{Nd}", r"[|#$%&*]")]
    words = F.size(T.word_tokens("text", WORD)).cast("double")
    coded = catalogue.encode_labels(table.withColumn("x", F.array(*counts, words)).drop("text"), "lang", "label")
    return scale.settled(coded.withColumn("label", F.col("label").cast("double")))


@query
def boost_first_borders(spark, folder):
    """The best border of every feature for the first level, over given borders: gains of the log loss with l2 of one."""
    rows = _mark_features(spark, folder).select("x", F.col("label").cast("int").alias("label"), F.lit(1.0).alias("weight"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    start = np.log([counts[k] / sum(counts.values()) for k in range(len(counts))])
    borders = [np.array([0.0, 1, 2, 5, 10, 20, 50, 100, 200, 500, 1000])] * 9
    found, _, _ = boosting.best_borders(boosting.state_of(rows, borders, start), [], boosting.Tree(), [12] * 9, len(counts), 1.0)
    return spark.createDataFrame([(b.feature, float(borders[0][b.bin]), round(b.gain, 6)) for b in found], "feature int, border double, gain double")


@query
def softmax_boost_scores(spark, folder):
    """Thirty rounds of trees for four classes at once; the training loss falls in every round."""
    table = _mark_features(spark, folder).withColumn("vec", array_to_vector("x"))
    table = scale.settled(splits.stratified_holdout(table, "lang", "doc_id"))
    params = {"iterations": 30, "learning_rate": 0.125, "max_depth": 3, "l2_leaf_reg": 0.163}
    model = classifiers.softmax_boosted("vec", params).fit(table.where("split = 'train'"))
    rows = outcome(spark, folder, model.transform(table), probabilities="probability")
    held = scale.settled(model.transform(table.where("split = 'test'")))
    most = held.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    better = held.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0] > most
    falling = all(b <= a for a, b in zip(model.losses, model.losses[1:]))
    return rows.withColumns({"falling": F.lit(falling and len(model.trees) == 30), "held_out_better": F.lit(bool(better))})


@query
def soft_vote(spark, folder):
    table, inputs = prepared(spark, folder)
    part = scale.settled(table.where("split = 'train'"))
    left = fit_classifier("BoW stats poly MultinomialNB", SHORT, inputs, part).transform(table)
    right = fit_classifier("TF-IDF stats poly LR", SHORT, inputs, part).transform(table)
    voted = inference.soft_vote(left, right, "doc_id").select("doc_id", "prediction", "probability")
    return outcome(spark, folder, table.select("doc_id", "split", "label").join(voted, "doc_id"), probabilities="probability")


@query
def embedding_head(spark, folder):
    vectors = read_table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("double"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vec")
    )
    table = scale.settled(splits.nested_holdout(vectors, "label", "vec_id"))
    parts = {s: table.where(F.col("split") == s) for s in ("train", "valid")}
    classes = int(table.agg(F.max("label")).first()[0]) + 1
    model = classifiers.embedding_head(parts["train"], parts["valid"], classes, "vec")
    return outcome(spark, folder, model.transform(table), table="embeddings", name="label", probabilities="probability")


@query
def pruned_forest_scores(spark, folder):
    """A forest pruned by cost complexity: no tree grows, the leaves are those its pruning path names for the alpha."""
    table = _mark_features(spark, folder).withColumn("vec", array_to_vector("x"))
    table = scale.settled(splits.stratified_holdout(table, "lang", "doc_id"))
    part = table.where("split = 'train'")
    common = {"featuresCol": "vec", "labelCol": "label"}
    params = {"n_estimators": 20, "max_depth": 12, "criterion": "entropy"}
    whole = classifiers.forest(params, **common).fit(part)
    small = classifiers.forest({**params, "ccp_alpha": 0.01}, **common).fit(part)
    path = pruning.pruning_path(whole).where("alpha <= 0.01").groupBy("tree").agg(F.min("leaves").alias("leaves"))
    named = {r["tree"]: r["leaves"] for r in path.collect()}
    kept = [(t.numNodes + 1) // 2 for t in small.trees]
    fewer = kept == [named[k] for k in range(20)] and sum(kept) < sum((t.numNodes + 1) // 2 for t in whole.trees)
    return outcome(spark, folder, small.transform(table), probabilities="probability").withColumn("fewer", F.lit(fewer))


@query
def relu_head_scores(spark, folder):
    """The head with ReLU and a class-weighted loss; the layers of the epoch with the lowest validation loss are kept."""
    vectors = read_table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("double"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vec")
    )
    table = splits.nested_holdout(vectors, "label", "vec_id").withColumn("held", F.col("split") == "valid")
    table = scale.settled(table)
    stage = head.ReluHead(featuresCol="vec", hidden=128, epochs=6, batches=2, rate=0.01, validCol="held")
    model = stage.fit(table.where("split <> 'test'"))
    rows = outcome(spark, folder, model.transform(table), table="embeddings", name="label", probabilities="probability")
    lowest = min(v for _, v in model.losses)
    state, _, _ = stage._state(table.where("split <> 'test'"))
    best = abs(head.mean_loss(state.where("valid"), model.layers) - lowest) < 1e-9
    return rows.withColumn("best", F.lit(best and model.losses[-1][0] < model.losses[0][0]))


@query
def guided_trials(spark, folder):
    """Twelve guided trials of the smoothing of a naive Bayes model on three folds, some ended early."""
    table = _mark_features(spark, folder).withColumn("vec", array_to_vector("x"))
    folds = splits.stratified_folds(table, "lang", "doc_id", 3)
    table = scale.settled(table.join(folds.select("doc_id", "fold"), "doc_id"))
    space = {"alpha": (1e-3, 1e3, "log"), "model_type": ["multinomial", "complement"]}

    def make(params: dict, n_rows: int) -> tuple[list, list]:
        return [], [NaiveBayes(modelType=params["model_type"], smoothing=params["alpha"], featuresCol="vec", labelCol="label")]

    trials = guided.tune_guided(make, space, table, 3, 12)
    rows = guided.trials_table(trials, spark)
    whole = [t.score for t in trials if not t.ended]
    ordered = whole == sorted(whole, reverse=True) and [t.ended for t in trials] == sorted(t.ended for t in trials)
    alpha = F.col("params")["alpha"].cast("double")
    bounded = F.col("score").between(0, 1) & alpha.between(1e-3, 1e3) & (F.col("ended") == (F.col("n_folds") < 3))
    return rows.select("trial", F.size("params").alias("n_params"), bounded.alias("bounded"), F.lit(ordered).alias("ordered"))


@query
def random_search(spark, folder):
    """Ten draws over the whole space on five grouped folds, all of them returned, and the best one fitted again on every row."""
    table, inputs = prepared(spark, folder)
    grouped = table.withColumn("book", F.floor(F.col("doc_id") / 3))
    folds = splits.stratified_group_folds(grouped, "label", "book", 5)
    folds = scale.settled(grouped.join(folds.select("book", "fold"), "book"))
    found = search.random_search("BoW stats poly LR", folds, inputs)
    rows = search.results_table(found, spark)
    scores = [F.col(f"{m}_{s}") for m in search.METRICS for s in ("mean", "std")]
    best = max(r["f1_weighted_mean"] for r in found) == found[0]["f1_weighted_mean"]
    again = fit_classifier("BoW stats poly LR", found[0]["params"], inputs, folds).transform(folds)
    seen = outcome(spark, folder, again, probabilities="probability").where("known AND bounded AND learned").count()
    n_rows = folds.count()
    leaks = folds.groupBy("book").agg(F.count_distinct("fold").alias("n")).where("n > 1").count()
    bounded = F.forall(F.array(*scores), lambda x: (x >= 0) & (x <= 1))
    bounded = F.lit(rows.where(bounded).count() == len(found))
    return rows.select("draw", bounded.alias("bounded"), F.lit(best and seen == n_rows).alias("best_first"), F.lit(leaks).cast("bigint").alias("n_leaks"), F.lit(n_rows).cast("bigint").alias("n_rows"))


@query
def random_search_draws(spark, folder):
    """Ten draws on five grouped folds over the whole space, nothing held: every draw with its bounds, in order of score."""
    table, inputs = prepared(spark, folder)
    grouped = table.withColumn("book", F.floor(F.col("doc_id") / 3))
    folds = splits.stratified_group_folds(grouped, "label", "book", 5)
    folds = scale.settled(grouped.join(folds.select("book", "fold"), "book"))
    found = search.random_search("BoW stats poly LR", folds, inputs)
    means = [r["f1_weighted_mean"] for r in found]
    ordered = means == sorted(means, reverse=True)
    rows = search.results_table(found, spark)
    scores = F.array(*[F.col(f"{m}_{s}") for m in search.METRICS for s in ("mean", "std")])
    return rows.select("draw", F.size("params").alias("n_params"), F.forall(scores, lambda x: (x >= 0) & (x <= 1)).alias("bounded"), F.lit(ordered).alias("ordered"))


@query
def training_run(spark, folder):
    table, inputs = prepared(spark, folder)
    grouped = table.withColumn("book", F.floor(F.col("doc_id") / 3))
    parts = [grouped.where(F.col("split") == s) for s in ("train", "test")]
    result = train("TF-IDF stats poly MultinomialNB", parts[0].drop("weight"), parts[1], inputs, "book", fixed_params=SHORT)
    scored = result.model.transform(parts[1]).withColumn("prediction", F.col("prediction"))
    rows = outcome(spark, folder, scored, probabilities="probability")
    best = F.lit(0 <= result.best["f1_weighted_std"] <= result.best["f1_weighted_mean"] <= 1)
    return rows.withColumn("best", best)


def _topic_vectors(spark, folder):
    table = docs(spark, folder)
    words = lexicon.synthetic_lexicon(table)
    lemmas = topics.content_lemmas(table, words, "doc_id", **CONTENT)
    rows = topics.content_rows(table, words, "doc_id", **CONTENT)
    listed = topics.build_dictionary(topics.lemma_counts(rows, "doc_id"), table.count())
    vectors, model = topics.count_vectors(lemmas, listed)
    return scale.settled(vectors.drop("lemmas")), model.vocabulary


@query
def lda_topics(spark, folder):
    """Dominant topics for five numbers of topics; the largest of k shares is 1 / k at least."""
    vectors, words = _topic_vectors(spark, folder)
    parts = []
    for k, model in topics.fit_lda_grid(vectors, (10, 15, 20, 25, 30), passes=10).items():
        found = topics.dominant_topic(vectors, model, words)
        empty = ~F.exists(vector_to_array("features"), lambda x: x > 0)  # no word of the dictionary: no shares
        share = (F.col("probability") <= 1 + 1e-9) & (F.col("probability") >= 1 / k - 1e-6)
        shown = F.col("topic").between(0, k - 1) & F.when(empty, F.col("probability") == 0).otherwise(share)
        parts.append(found.select("doc_id", F.lit(k).alias("k"), shown.alias("bounded")))
    return splits.union_corpora(*parts)


@query
def svd_coords(spark, folder):
    """Coordinates on five components: energies fall, stay below the squared norm, and columns are orthogonal."""
    rows = _bow(spark, folder)
    model = TruncatedSvd(inputCol="bow", outputCol="comps", k=5).fit(rows)
    square = F.aggregate(F.unwrap_udt("bow")["values"], F.lit(0.0), lambda s, x: s + x * x)  # of the entries, not of the whole width
    reduced = scale.settled(model.transform(rows).select("doc_id", vector_to_array("comps").alias("c"), square.alias("s")))
    products = [F.sum(F.col("c")[i] * F.col("c")[j]).alias(f"p{i}{j}") for i in range(5) for j in range(i, 5)]
    norm = F.sum("s").alias("norm")
    found = reduced.agg(norm, *products).first()
    energy = [found[f"p{i}{i}"] for i in range(5)]
    falling = all(x >= y * (1 - 1e-6) for x, y in zip(energy, energy[1:])) and sum(energy) <= found["norm"] * (1 + 1e-9)
    square = all(abs(found[f"p{i}{j}"]) <= 0.02 * (energy[i] * energy[j]) ** 0.5 for i in range(5) for j in range(i + 1, 5))
    return reduced.select("doc_id", F.lit(falling).alias("falling"), F.lit(square).alias("orthogonal"), F.lit(int(round(found["norm"]))).cast("bigint").alias("squared_norm"))


@query
def pca_variance(spark, folder):
    """The curve over the whole bag of words; the SQL names the first five points, ``rising`` holds for all nine."""
    curve = scale.settled(explained_curve(_bow(spark, folder), [10, 20, 30, 40, 50, 100, 150, 200, 500], "bow"))
    shares = [r["explained"] for r in curve.orderBy("k").collect()]
    rising = all(0 < x <= y * (1 + 1e-9) for x, y in zip(shares, shares[1:])) and shares[-1] <= 1 + 1e-9
    return curve.where("k <= 50").select("k", F.lit(rising).alias("rising"))


# streams


def _arriving(spark, folder) -> DataFrame:
    """The events as a stream of four files, the latest quarter of the time first."""
    base = run_folder(spark, "arriving")
    events = read_table(spark, folder, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.floor(
        4 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")))
        / (F.unix_micros(F.lit(last).cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")) + 1)
    )
    for number in (3, 2, 1, 0):
        part = events.where(quarter == number) if last > first else events.limit(0 if number else 1 << 30)
        part.coalesce(1).write.mode("append").parquet(base)
    return stream_usage.event_stream(spark, base, files_per_batch=1)


def _drained(spark, folder, part, label: str) -> str:
    base = run_folder(spark, label)
    run = stream_usage.write_parts(_arriving(spark, folder), part, f"{base}/rows", f"{base}/state", every=None)
    run.awaitTermination()
    return f"{base}/rows"


@query
def usage_stream(spark, folder):
    return stream_usage.read_windows(spark, _drained(spark, folder, stream_usage.usage_windows(), "usage"))


@query
def new_user_stream(spark, folder):
    found = stream_usage.read_new_users(spark, _drained(spark, folder, stream_usage.new_users, "users"))
    return found.select("user_id", F.col("since.event_id").alias("first_event"))


@query
def user_counter_stream(spark, folder):
    return stream_usage.read_user_counters(spark, _drained(spark, folder, stream_usage.user_events, "counters"))


@query
def score_stream(spark, folder):
    """Every document scored as it arrives by a model with lemmas and part-of-speech statistics, and again as a table."""
    table, inputs = prepared(spark, folder)
    part = table.where("split = 'train'").drop(*stat_columns())
    model = fit_classifier("BoW stats poly MultinomialNB", {**SHORT, "text__lemmatize": True}, inputs, part)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    texts = stream_scoring.table_stream(spark, folder, "documents", schema)
    base = run_folder(spark, "scored")
    stream_scoring.score_stream(texts, model, ["doc_id"], f"{base}/rows", f"{base}/state", every=None).awaitTermination()
    streamed = stream_scoring.read_scored(spark, f"{base}/rows")
    again = inference.predict_authors(model.transform(docs(spark, folder)), ["doc_id"], return_names=True)
    both = streamed.join(again.select("doc_id", F.col("label").alias("l"), F.col("name").alias("n")), "doc_id")
    same = F.col("label").eqNullSafe(F.col("l")) & F.col("name").eqNullSafe(F.col("n"))
    return both.select("doc_id", F.col("label").between(-1, 9).alias("known"), same.alias("same"))
