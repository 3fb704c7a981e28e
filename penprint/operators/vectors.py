"""Numeric columns and vectors: clipping, class weights, scaling, projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import (
    IDF, PCA, CountVectorizer, ElementwiseProduct, Normalizer, PCAModel, PolynomialExpansion,
    StandardScaler, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from penprint.operators import blocks
from penprint.operators.scale import exact_quantiles, lookup_join, settled

EVERY_TERM = 2**31 - 1


def clip_upper(df: DataFrame, columns: Sequence[str], q: float = 0.99, width: float = 1.0) -> DataFrame:
    """Cap columns at their exact ``q`` quantile."""
    tops = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], columns, q, width)
    limits = {r["stat"]: r["value"] for r in tops.collect()}
    capped = {
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.lit(limits[c])))
        for c in columns
        if c in limits
    }
    return df.withColumns(capped)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): rows / (classes * rows of the class)."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    weight = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counted.withColumn("weight", weight)


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return lookup_join(df, settled(weights), [label])


def assemble(columns: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out)


def poly2(source: str, out: str) -> PolynomialExpansion:
    """Degree-2 terms; the bias column is left to the model's intercept."""
    return PolynomialExpansion(degree=2, inputCol=source, outputCol=out)


def scaler(source: str, out: str, with_mean: bool = False) -> StandardScaler:
    return StandardScaler(withMean=with_mean, withStd=True, inputCol=source, outputCol=out)


def population_scaled(df: DataFrame, source: str, out: str, with_mean: bool = False) -> DataFrame:
    """Scale by the population deviation: Spark's sample deviation times sqrt(n/(n-1))."""
    n = df.count()
    scaled = scaler(source, "_scaled", with_mean).fit(df).transform(df)
    factor = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    width = df.select(F.size(vector_to_array(source)).alias("d")).first()["d"]
    stretch = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * width), inputCol="_scaled", outputCol=out
    )
    return stretch.transform(scaled).drop("_scaled")


class SmoothIdf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Inverse document frequency plus one, as an elementwise factor."""

    @keyword_only
    def __init__(self, *, inputCol="tf", outputCol="weighted"):
        super().__init__()
        self._setDefault(inputCol="tf", outputCol="weighted")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        idf = IDF(inputCol=self.getInputCol(), outputCol="_idf").fit(dataset).idf
        return ElementwiseProduct(
            scalingVec=Vectors.dense(idf.toArray() + 1.0),
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
        )


def count_stage(
    tokens: str, out: str, min_df: float = 1, max_df: float = 1.0, size: int | None = None, n_docs: int = 1
) -> CountVectorizer:
    """Term counts. Whole numbers of ``min_df`` and ``max_df`` count documents, fractions up to 1.0 are shares.

    A largest share of 1.0 keeps every term, and a smallest of 1.0 those of all ``n_docs`` documents; Spark reads 1.0
    as one document. Without a size the vocabulary has no limit.
    """
    limits = {}
    if not (isinstance(max_df, float) and max_df >= 1.0):
        limits["maxDF"] = float(max_df)
    whole = isinstance(min_df, float) and min_df == 1.0
    limits["minDF"] = float(n_docs if whole else min_df)
    return CountVectorizer(inputCol=tokens, outputCol=out, vocabSize=size or EVERY_TERM, **limits)


def tfidf_stages(
    tokens: str, out: str, min_df: float = 1, max_df: float = 1.0, size: int | None = None, n_docs: int = 1
) -> list:
    """Counts, smoothed idf, L2 norm."""
    return [
        count_stage(tokens, f"{out}_tf", min_df, max_df, size, n_docs),
        SmoothIdf(inputCol=f"{out}_tf", outputCol=f"{out}_w"),
        Normalizer(inputCol=f"{out}_w", outputCol=out, p=2.0),
    ]


class TableWriter(MLWriter):
    """Saves a fitted stage as Parquet: its parameters and one table."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc, paramMap=None)
        self.stage.table(self.sparkSession).write.parquet(f"{path}/table")


class TableReader(MLReader):
    """Loads a stage from its parameters and its table."""

    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        stage = self.kind.from_table(self.sparkSession.read.parquet(f"{path}/table"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class TruncatedSvd(Estimator, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Projection on the leading right singular vectors, without centring.

    Block power iteration from random directions: a few more than wanted are multiplied by the rows and their
    transpose and made orthogonal again. The directions lie in files (``blocks``); nothing of the input width is on the
    driver, and nothing of its square is built.
    """

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)
    rounds = Param(Params._dummy(), "rounds", "power iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="embed", outputCol="reduced", k=100, rounds=6, seed=42):
        super().__init__()
        self._setDefault(inputCol="embed", outputCol="reduced", k=100, rounds=6, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SvdModel:
        source, k, spark = self.getInputCol(), self.getOrDefault("k"), dataset.sparkSession
        rows = dataset.select(source)
        first = rows.first()
        width = first[source].size if first else 0
        if not width:
            return self._copyValues(SvdModel(blocks.empty(spark, 0, 0), np.zeros(0)))
        found, values = blocks.leading(rows, source, width, min(k + 10, width), self.getOrDefault("rounds"), self.getSeed())
        kept = min(k, width)
        turn, values = found.turn[:, :kept], np.sqrt(values[:kept])
        missing = kept - len(values)  # directions without any row's part
        found = replace(found, turn=np.pad(turn, ((0, 0), (0, missing))))
        return self._copyValues(SvdModel(blocks.signed(spark, found), np.pad(values, (0, missing))))


class SvdModel(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """Scalar products with the singular vectors, a block in files; ``values`` are the singular values."""

    def __init__(self, block: blocks.Block, values: np.ndarray):
        super().__init__()
        self.block, self.values = block, values

    @property
    def vectors(self) -> np.ndarray:
        return self.block.whole()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        block = self.block

        @F.pandas_udf("array<double>")
        def project(kinds: pd.Series, indices: pd.Series, values: pd.Series) -> pd.Series:
            if not len(kinds):
                return pd.Series([], dtype=object)
            found = [(np.arange(len(x)) if kind == 1 else i, x) for kind, i, x in zip(kinds, indices, values)]
            at = np.repeat(np.arange(len(found)), [len(x) for _, x in found])
            columns = np.concatenate([np.asarray(i, np.int64) for i, _ in found])
            return pd.Series(list(blocks.images(block, at, columns, np.concatenate([np.asarray(x, np.float64) for _, x in found]), len(found))))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(*blocks.plain(dataset, self.getInputCol()))))

    def table(self, spark) -> DataFrame:
        return blocks.as_table(spark, self.block).unionByName(spark.createDataFrame([(-1, self.values.tolist())], "row int, numbers array<double>"))

    @classmethod
    def from_table(cls, table: DataFrame) -> SvdModel:
        values = np.array(table.where("row < 0").first()["numbers"])
        return cls(blocks.of_table(table.where("row >= 0"), len(values)), values)

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


def pca(df: DataFrame, k: int, source: str = "features", out: str = "pca") -> PCAModel:
    return PCA(k=k, inputCol=source, outputCol=out).fit(df)


def explained_curve(df: DataFrame, ks: Sequence[int], source: str = "features", rounds: int = 60, close: float = 1e-5, seed: int = 42) -> DataFrame:
    """Share of the variance of all columns that the first ``k`` principal components keep, from one block iteration.

    Rows are centred by taking the means' part off the products, so sparse rows stay sparse and nothing of the width
    squared is built. The block is multiplied until no share grows by more than ``close``, ``rounds`` times at most.
    """
    spark = df.sparkSession
    known = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(source)).alias("s")).first()["s"]
    mean, total, n = known["mean"].toArray(), float(known["variance"].toArray().sum()), int(known["count"])
    size = min(max(ks) + 10, len(mean))
    block = blocks.drawn(spark, len(mean), size, seed)
    rows = blocks.cut(df, source, block)
    upper, along, _ = blocks.facts(spark, block, mean=mean)
    block = blocks.orthonormal(block, upper)
    shares = np.full(len(ks), -1.0)
    for _ in range(rounds):
        image = blocks.multiplied(spark, rows, block, mean, n * (along @ block.turn))
        upper, along, cross = blocks.facts(spark, image, block, mean)
        square = block.turn.T @ cross
        values = np.sort(np.maximum(np.linalg.eigvalsh((square + square.T) / 2), 0.0))[::-1] / max(1, n - 1)
        before, shares = shares, np.array([values[:k].sum() for k in ks]) / (total or 1.0)
        block.drop()
        block = blocks.orthonormal(image, upper)
        if size == len(mean) or np.max(shares - before) <= close or not block.turn.shape[1]:
            break
    block.drop()
    rows.drop()
    found = [(int(k), float(x)) for k, x in zip(ks, shares)]
    return df.sparkSession.createDataFrame(found, "k int, explained double")


class RandomFourier(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Random Fourier features: dot products approximate an RBF kernel.

    ``gamma`` zero means one over the input width, which suits scaled inputs.
    """

    features = Param(Params._dummy(), "features", "output width", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="scaled", outputCol="features", features=256, gamma=0.0, seed=42):
        super().__init__()
        self._setDefault(inputCol="scaled", outputCol="features", features=256, gamma=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        width_out, gamma, seed = self.getOrDefault("features"), self.getOrDefault("gamma"), self.getSeed()

        @F.pandas_udf("array<double>")
        def lift(kinds: pd.Series, sizes: pd.Series, indices: pd.Series, values: pd.Series) -> pd.Series:
            if not len(kinds):
                return pd.Series([], dtype=object)
            found = [(np.arange(len(x)) if kind == 1 else i, x) for kind, i, x in zip(kinds, indices, values)]
            width = len(values.iloc[0]) if kinds.iloc[0] == 1 else int(sizes.iloc[0])
            out = lifted_rows(found, width, width_out, gamma if gamma > 0 else 1.0 / width, seed)
            return pd.Series(list(out))

        plain = F.unwrap_udt(F.col(self.getInputCol()))
        lifted = lift(plain["type"], plain["size"], plain["indices"], plain["values"])
        return dataset.withColumn(self.getOutputCol(), array_to_vector(lifted))


def lifted_rows(rows: Sequence, width: int, width_out: int, scale: float, seed: int, block: int = 8192, entries: int = 8192) -> np.ndarray:
    """Random Fourier features of rows given as (columns, values); only their entries count.

    The directions are drawn in one stream, ``block`` input columns at a time, and the products of ``entries`` entries
    are held at once, so that the memory does not grow with the input width.
    """
    lengths = [len(x) for _, x in rows]
    at = np.repeat(np.arange(len(rows)), lengths)
    columns = np.concatenate([np.asarray(i, np.int64) for i, _ in rows])
    numbers = np.concatenate([np.asarray(x, np.float64) for _, x in rows])
    order = np.argsort(columns // block, kind="stable")  # by block, rows in order
    at, columns, numbers = at[order], columns[order], numbers[order]
    draws, out = np.random.default_rng(seed), np.zeros((len(rows), width_out))
    for low in range(0, width, block):
        high = min(low + block, width)
        weights = draws.normal(0.0, np.sqrt(2.0 * scale), (high - low, width_out))
        begin, end = np.searchsorted(columns // block, [low // block, low // block + 1])
        for k in range(begin, end, entries):
            part = slice(k, min(k + entries, end))
            starts = np.flatnonzero(np.diff(at[part], prepend=-1))
            out[at[part][starts]] += np.add.reduceat(weights[columns[part] - low] * numbers[part, None], starts, axis=0)
    shift = draws.uniform(0.0, 2.0 * np.pi, width_out)
    return np.sqrt(2.0 / width_out) * np.cos(out + shift)
