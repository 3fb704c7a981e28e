"""Named classifiers: text embedding and statistics, scaled, then an estimator.

Every name is ``<embedding> stats [poly] <kind>``. Search spaces are plain lists
per component; ``make_classifier`` turns one draw into a Spark ML pipeline.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
    OneVsRest, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import fixed
from penprint.operators.boosting import SoftmaxBoosting
from penprint.operators.extractor import LearnedSize, NgramRange, TextStatsExtractor
from penprint.operators.neighbours import knn_predict
from penprint.operators.pruning import PrunedForest
from penprint.operators.recipes import TextTransformer
from penprint.operators.scale import settled, stored
from penprint.operators.vectors import (
    RandomFourier, TableReader, TableWriter, TruncatedSvd, assemble, count_stage, poly2, scaler, tfidf_stages,
)

# Search spaces per component.
TEXT_SPACE = {
    "remove_punctuation": [True, False],
    "remove_stopwords": [True, False],
    "lemmatize": [True, False],
}
VECTOR_SPACE = {
    "min_df": [5, 10, 20, 30],
    "max_df": [0.5, 0.75, 1.0],
    "ngram_range": [(1, 1), (1, 2), (1, 3)],
}
STATS_SPACE = {"pos_stats": [True, False], "sent_stats": [True, False]}
SVD_SPACE = {"n_components": [int(k) for k in np.linspace(20, 200, 10)]}
LOG_GRID = [float(c) for c in np.logspace(-3, 3, 20)]
MODEL_SPACES = {
    "LR": {"C": LOG_GRID, "class_weight": [None, "balanced"]},
    "SVM": {"C": LOG_GRID, "class_weight": [None, "balanced"], "kernel": ["linear", "rbf"]},
    "MultinomialNB": {"alpha": LOG_GRID},
    "KNN": {"n_neighbors": [5, 10, 25, 50], "weights": ["uniform", "distance"]},
    "RF": {
        "n_estimators": [100, 150, 200, 250, 300],
        "max_depth": [5, 10, 20, None],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": ["sqrt", "log2"],
    },
}
# Ranges of the sequentially tuned models, sampled evenly or by logarithm.
BOOST_RANGES = {
    "iterations": (100, 500, "int"),
    "learning_rate": (0.01, 0.2, "log"),
    "l2_leaf_reg": (1e-3, 10, "log"),
    "max_depth": (1, 10, "int"),
}
FOREST_RANGES = {
    "n_estimators": [100, 300, 600, 900, 1200, 1500],
    "max_depth": (1, 500, "int"),
    "min_samples_split": (2, 200, "logint"),
    "criterion": ["gini", "entropy", "log_loss"],
    "ccp_alpha": (0.0, 0.1, "even"),
}

REDUCED = {"KNN", "RF"}
ITERATIVE = {"LR", "SVM"}
PLAIN_STATS = {"KNN"}
MAX_TREE_DEPTH = 30  # of Spark's trees


@dataclass(frozen=True)
class ClassifierSpec:
    name: str
    embedding: str
    kind: str

    @property
    def poly(self) -> bool:
        return self.kind not in PLAIN_STATS

    @property
    def iterative(self) -> bool:
        return self.kind in ITERATIVE

    @property
    def reduced(self) -> bool:
        return self.kind in REDUCED

    @property
    def space(self) -> dict[str, list]:
        """Search space with ``step__param`` names."""
        steps = {
            "text": TEXT_SPACE,
            "vectorizer": VECTOR_SPACE,
            "stats": STATS_SPACE,
            "svd": SVD_SPACE if self.reduced else {},
            "model": MODEL_SPACES[self.kind],
        }
        return {f"{step}__{k}": v for step, params in steps.items() for k, v in params.items()}


def _specs() -> dict[str, ClassifierSpec]:
    specs = {}
    for kind in MODEL_SPACES:
        for embedding in ("TF-IDF", "BoW"):
            poly = "" if kind in PLAIN_STATS else "poly "
            name = f"{embedding} stats {poly}{kind}"
            specs[name] = ClassifierSpec(name, embedding, kind)
    return specs


CLASSIFIERS = _specs()


@dataclass(frozen=True)
class Inputs:
    """How a corpus feeds a classifier: columns, word pattern, stop words, lexicon."""

    doc: str = "doc_id"
    text: str = "text"
    label: str = "label"
    pattern: str = fixed.CYRILLIC_WORD
    stopwords: tuple[str, ...] = ()
    lexicon_path: str | None = None


class CosineKnn(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """K nearest neighbours by cosine distance as a pipeline stage."""

    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row key", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", k=5, weights="uniform",
        idCol="doc_id",
    ):
        super().__init__()
        self._setDefault(k=5, weights="uniform", idCol="doc_id")
        self._set(**self._input_kwargs)

    def _vectors(self, df: DataFrame, *more) -> DataFrame:
        return df.select(self.getOrDefault("idCol"), vector_to_array(self.getFeaturesCol()).alias("vec"), *more)

    def _fit(self, dataset: DataFrame) -> CosineKnnModel:
        label = F.col(self.getLabelCol()).cast("int").alias("label")
        return self._copyValues(CosineKnnModel(settled(self._vectors(dataset, label))))


class CosineKnnModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, MLWritable, MLReadable):
    """The training vectors and how to vote; rows without an answer have a null prediction."""

    k, weights, idCol = CosineKnn.k, CosineKnn.weights, CosineKnn.idCol

    def __init__(self, train: DataFrame):
        super().__init__()
        self._setDefault(k=5, weights="uniform", idCol="doc_id")
        self.train = train

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, get = self.getOrDefault("idCol"), self.getOrDefault
        asked = dataset.select(key, vector_to_array(self.getFeaturesCol()).alias("vec"))
        known = self.train.withColumnRenamed(self.train.columns[0], key)
        found = knn_predict(known, asked, get("k"), get("weights"), id_col=key, skip_self=False)
        prediction = F.col("prediction").cast("double").alias(self.getPredictionCol())
        return dataset.join(found.select(F.col("id").alias(key), prediction), key, "left")

    def table(self, spark) -> DataFrame:
        return self.train

    @classmethod
    def from_table(cls, table: DataFrame) -> CosineKnnModel:
        return cls(table)

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


def _estimator(kind: str, params: dict, n_rows: int, label: str, doc: str) -> list:
    """The estimator of a kind, with scikit-style settings mapped to Spark's."""
    common = {"featuresCol": "features", "labelCol": label}
    strength = 1.0 / (params.get("C", 1.0) * max(n_rows, 1))
    weight = {"weightCol": "weight"} if params.get("class_weight") == "balanced" else {}
    if kind == "LR":
        return [
            LogisticRegression(
                family="multinomial", regParam=strength, elasticNetParam=0.0, standardization=False,
                maxIter=params.get("max_iter", 200), **common, **weight,
            )
        ]
    if kind == "SVM":
        stages = []
        if params.get("kernel", "rbf") == "rbf":
            stages.append(RandomFourier(inputCol="features", outputCol="lifted"))
            common["featuresCol"] = "lifted"
        svc = LinearSVC(regParam=strength, maxIter=params.get("max_iter", 100), standardization=False, **common, **weight)
        return [*stages, OneVsRest(classifier=svc, parallelism=2, **common, **weight)]
    if kind == "MultinomialNB":
        return [NaiveBayes(modelType="multinomial", smoothing=params.get("alpha", 1.0), **common)]
    if kind == "KNN":
        return [CosineKnn(k=params.get("n_neighbors", 5), weights=params.get("weights", "uniform"), idCol=doc, **common)]
    if kind == "RF":
        return [forest(params, **common)]
    if kind == "GBT":
        gbt = GBTClassifier(
            maxIter=params.get("iterations", 20), stepSize=params.get("learning_rate", 0.1),
            maxDepth=params.get("max_depth", 5), seed=42, **common,
        )
        return [OneVsRest(classifier=gbt, parallelism=2, **common)]
    raise ValueError(f"unknown kind {kind}")


def forest(params: dict, **common) -> RandomForestClassifier:
    depth = params.get("max_depth") or MAX_TREE_DEPTH
    if depth > MAX_TREE_DEPTH:
        warnings.warn(f"trees stop at depth {MAX_TREE_DEPTH}, {depth} was asked for", stacklevel=2)
    criterion = params.get("criterion", "gini")
    pruning = {"ccp_alpha": params["ccp_alpha"]} if params.get("ccp_alpha") else {}
    return (PrunedForest if pruning else RandomForestClassifier)(
        **pruning,
        numTrees=params.get("n_estimators", 100),
        maxDepth=min(depth, MAX_TREE_DEPTH),
        minInstancesPerNode=max(params.get("min_samples_leaf", 1), params.get("min_samples_split", 2) // 2),
        featureSubsetStrategy=params.get("max_features", "sqrt"),
        impurity="gini" if criterion == "gini" else "entropy",
        seed=42,
        **common,
    )


def embedding_stages(spec: ClassifierSpec, step: dict, out: str, n_rows: int = 1) -> list:
    """N-grams of the tokens, counts or TF-IDF, and the SVD of the reduced kinds."""
    vec = step["vectorizer"]
    low, high = vec.get("ngram_range", (1, 1))
    size, min_df, max_df = vec.get("max_features"), vec.get("min_df", 1), vec.get("max_df", 1.0)
    wide = f"{out}_wide" if spec.reduced else out
    stages: list = [NgramRange(inputCol="tokens", outputCol="grams", nMin=low, nMax=high)]
    if spec.embedding == "TF-IDF":
        stages += tfidf_stages("grams", wide, min_df, max_df, size, n_rows)
    else:
        stages.append(count_stage("grams", wide, min_df, max_df, size, n_rows))
    if spec.reduced:
        stages.append(TruncatedSvd(inputCol=wide, outputCol=out, k=step["svd"].get("n_components", 100)))
    return [*stages, LearnedSize(inputCol=out)]


def make_stages(
    name: str, params: dict | None = None, inputs: Inputs | None = None, n_rows: int = 1
) -> tuple[list, list]:
    """Stages of a named classifier for one draw of ``step__param`` values.

    The first list works text by text and learns nothing, so its output can be
    kept for all folds; the second list is fitted.
    """
    spec, inputs = CLASSIFIERS[name], inputs or Inputs()
    step: dict[str, dict] = {s: {} for s in ("text", "vectorizer", "stats", "svd", "model")}
    for key, value in (params or {}).items():
        where, _, param = key.partition("__")
        step[where][param] = value
    text, has_lexicon = step["text"], inputs.lexicon_path is not None
    local = [
        TextTransformer(
            inputCol=inputs.text, outputCol="tokens", removePunctuation=text.get("remove_punctuation", True),
            removeStopwords=text.get("remove_stopwords", True), lemmatize=has_lexicon and text.get("lemmatize", True),
            wordPattern=inputs.pattern, stopwords=list(inputs.stopwords), lexiconPath=inputs.lexicon_path,
            idCol=inputs.doc,
        ),
        TextStatsExtractor(
            inputCol=inputs.text, outputCol="stats", sentStats=step["stats"].get("sent_stats", True),
            posStats=has_lexicon and step["stats"].get("pos_stats", True), wordPattern=inputs.pattern,
            lexiconPath=inputs.lexicon_path, idCol=inputs.doc,
        ),
    ]
    learned = embedding_stages(spec, step, "embed", n_rows)
    if spec.poly:
        learned += [poly2("stats", "stats_poly"), LearnedSize(inputCol="stats_poly")]
    learned += [
        assemble(["embed", "stats_poly" if spec.poly else "stats"], "joined"),
        scaler("joined", "features"),
        *_estimator(spec.kind, step["model"], n_rows, inputs.label, inputs.doc),
    ]
    return local, learned


def make_classifier(name: str, params: dict | None = None, inputs: Inputs | None = None, n_rows: int = 1) -> Pipeline:
    """The whole classifier as one pipeline."""
    local, learned = make_stages(name, params, inputs, n_rows)
    return Pipeline(stages=[*local, *learned])


def light(df: DataFrame, last) -> DataFrame:
    """What the last stage needs, fixed on disk: an iterative fit must not carry the stages before it in every task.

    Every task of a round sends gradients of the whole width, so there are no more tasks than cores.
    """
    features = last.getFeaturesCol()
    plain = [c for c, kind in df.dtypes if c == features or not kind.startswith(("array", "vector", "string", "map", "struct"))]
    ready = stored(df.select(plain), "light").coalesce(df.sparkSession.sparkContext.defaultParallelism)
    return ready.withMetadata(features, df.schema[features].metadata)


def fit_classifier(name: str, params: dict | None, inputs: Inputs, train: DataFrame) -> PipelineModel:
    """Fit a named classifier; tokens and statistics are computed once for all stages."""
    local, learned = make_stages(name, params, inputs, train.count())
    features = PipelineModel(local).transform(train).drop(inputs.text).persist()
    *before, last = learned
    try:
        ready = Pipeline(stages=before).fit(features)
        table = light(ready.transform(features), last) if CLASSIFIERS[name].iterative else ready.transform(features)
        fitted = last.fit(table)
    finally:
        features.unpersist()
    return PipelineModel([*local, *ready.stages, fitted])


def boosted(source: str, params: dict | None = None, label: str = "label") -> Pipeline:
    """One-vs-rest gradient boosting on a vector column."""
    stages = _estimator("GBT", params or {}, 1, label, "doc_id")
    stages[-1].getClassifier().setFeaturesCol(source)
    stages[-1].setFeaturesCol(source)
    return Pipeline(stages=stages)


def softmax_boosted(source: str, params: dict | None = None, label: str = "label", weight: str | None = None) -> SoftmaxBoosting:
    """Multiclass boosting on a vector column with the names of ``BOOST_RANGES``."""
    params = params or {}
    return SoftmaxBoosting(
        featuresCol=source, labelCol=label, weightCol=weight, iterations=params.get("iterations", 100),
        learningRate=params.get("learning_rate", 0.1), maxDepth=params.get("max_depth", 6), l2=params.get("l2_leaf_reg", 3.0),
    )


def embedding_head(
    train: DataFrame, valid: DataFrame, classes: int, vec_col: str, label: str = "label",
    hidden: int = 512, rounds: int = 4, iterations: int = 25, seed: int = 42,
):
    """A one-hidden-layer network on dense vectors; the best validation round is kept."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    width = train.select(vec_col).first()[0].size
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    best, best_loss, weights = None, float("inf"), None
    for _ in range(rounds):
        head = MultilayerPerceptronClassifier(
            layers=[width, hidden, classes], featuresCol=vec_col, labelCol=label, maxIter=iterations, seed=seed
        )
        if weights is not None:
            head = head.setInitialWeights(weights)
        model = head.fit(train)
        weights, loss = model.weights, judge.evaluate(model.transform(valid))
        if loss < best_loss:
            best, best_loss = model, loss
    return best
