"""Multiclass gradient boosting: one symmetric tree with a value per class and leaf in every round.

Features become codes of quantile bins once. A level of a tree is one pass: tasks add up gradients per feature, bin, node
and class, the sums meet by feature, and only each feature's best border comes to the driver. All classes share a
tree, so a round costs ``depth`` passes however many classes there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.scale import balanced, settled
from penprint.operators.vectors import TableReader, TableWriter

REFRESH = 16  # rounds after which the scores of all rows are written anew
SUMS_BYTES = 64 << 20  # sums that a task holds at once; more features take another pass


@dataclass
class Tree:
    """Feature and last left bin of every level, and values[leaf, class]; bit l of a leaf says right at level l."""

    features: list[int] = field(default_factory=list)
    bins: list[int] = field(default_factory=list)
    values: np.ndarray | None = None

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        for level, (f, b) in enumerate(zip(self.features, self.bins)):
            at |= (codes[:, f] > b).astype(np.int64) << level
        return at


def coded(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    """Bins of the columns: the number of borders below a value; what is no number goes to the first."""
    out = np.empty(x.shape, np.uint8)
    for f, border in enumerate(borders):
        out[:, f] = np.searchsorted(border, np.where(np.isnan(x[:, f]), -np.inf, x[:, f]), "left")
    return out


def raised(scores: np.ndarray, codes: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for tree in trees:
        scores = scores + tree.values[tree.leaves(codes)]
    return scores


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """First derivatives of the log loss, twice the diagonal of the second, and the loss.

    2 p (1 - p) bounds the whole matrix of second derivatives, so small steps lower the loss.
    """
    p = softmax(scores)
    rows = np.arange(len(labels))
    loss = -float((np.log(np.maximum(p[rows, labels], 1e-300)) * weights).sum())
    g = p.copy()
    g[rows, labels] -= 1
    return g * weights[:, None], 2 * p * (1 - p) * weights[:, None], loss


def quantile_borders(df: DataFrame, column: str, width: int, bins: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """At most ``bins`` - 1 borders per feature, from mergeable quantile summaries of all rows."""
    shares = [i / bins for i in range(1, bins)]
    found = []
    for low in range(0, width, 200):
        wanted = [F.percentile_approx(F.nullif(F.col(column)[f], F.lit(float("nan"))), shares, accuracy).alias(f"f{f}") for f in range(low, min(width, low + 200))]
        row = df.agg(*wanted).first()
        found += [np.unique(np.asarray(row[c] or [], np.float64)) for c in row.asDict()]
    return found


PART_BYTES = 4 << 20  # codes and scores of a partition, at least

STATE = "label int, weight double, codes binary, scores binary"


def state_of(df: DataFrame, borders: list[np.ndarray], start: np.ndarray) -> DataFrame:
    """Rows (x array, label, weight) as codes with their first scores, fixed on disk.

    Every pass goes over all partitions, so small tables are kept in few of them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(batch.num_rows, -1)
            codes = coded(x, borders)
            columns = [batch.column("label"), batch.column("weight"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([start.tobytes()] * len(codes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "weight", "codes", "scores"])

    parts = df.count() * (len(borders) + 8 * len(start)) // PART_BYTES + 1
    return settled(df.coalesce(parts).mapInArrow(run, STATE))


def opened(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    """Labels, weights, codes and scores of a batch of the state."""
    n = batch.num_rows
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, width)
    scores = np.frombuffer(b"".join(batch.column("scores").to_pylist()), np.float64).reshape(n, -1)
    return np.asarray(batch.column("label")), np.asarray(batch.column("weight")), codes, scores


def refreshed(state: DataFrame, width: int, trees: list[Tree]) -> DataFrame:
    """The state with the trees' values in the scores, fixed on disk; the trees so far need not be walked again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, _, codes, scores = opened(batch, width)
            new = pa.array([s.tobytes() for s in raised(scores, codes, trees)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("label", "weight", "codes")], new], ["label", "weight", "codes", "scores"])

    return settled(state.mapInArrow(run, STATE))


@dataclass
class Border:
    gain: float
    feature: int
    bin: int
    sums: np.ndarray  # side, node, (gradients, curvatures), class


def gains(sums: np.ndarray, l2: float) -> np.ndarray:
    """What each border of a feature gains, from sums[node, bin, 2, class]."""
    left = sums.cumsum(1)[:, :-1]
    whole = sums.sum(1, keepdims=True)

    def part(s: np.ndarray) -> np.ndarray:
        return (s[:, :, 0] ** 2 / (s[:, :, 1] + l2)).sum((0, 2))

    return part(left) + part(whole - left) - part(whole)


def best_borders(state: DataFrame, trees: list[Tree], tree: Tree, sizes: list[int], classes: int, l2: float) -> tuple[list[Border], float, float]:
    """The best border of every feature for the next level of ``tree``; the loss and weight of all rows before it."""
    width, nodes = len(sizes), 1 << len(tree.features)
    per_feature = nodes * max(sizes) * 2 * classes * 8
    step = max(1, min(width, SUMS_BYTES // per_feature))
    out: list[Border] = []
    loss = weight = 0.0
    for low in range(0, width, step):
        chosen = list(range(low, min(width, low + step)))

        def partial(batches: Iterable[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            sums = {f: np.zeros((nodes * sizes[f], 2 * classes)) for f in chosen}
            lost = np.zeros(2)
            for batch in batches:
                if not batch.num_rows:
                    continue
                labels, weights, codes, scores = opened(batch, width)
                g, h, row_loss = gradients(raised(scores, codes, trees), labels, weights)
                both = np.hstack([g, h])
                lost += [row_loss, weights.sum()]
                node = tree.leaves(codes)
                for f in chosen:
                    cell = node * sizes[f] + codes[:, f]
                    for k in range(2 * classes):
                        sums[f][:, k] += np.bincount(cell, both[:, k], nodes * sizes[f])
            part = TaskContext.get().partitionId()
            names, data = [-1, *chosen], [lost.tobytes(), *[sums[f].tobytes() for f in chosen]]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([part] * len(names), pa.int32()), pa.array(data, pa.binary())], ["feature", "part", "sums"])

        def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feature, total = None, None

            def done() -> Iterator[pa.RecordBatch]:
                if feature is None:
                    return
                gain, at, kept = 0.0, -1, total
                if feature >= 0 and sizes[feature] > 1:
                    by_bin = total.reshape(nodes, sizes[feature], 2, classes)
                    every = gains(by_bin, l2)
                    at = int(every.argmax())
                    gain, left = float(every[at]), by_bin[:, : at + 1].sum(1)
                    kept = np.stack([left, by_bin.sum(1) - left])
                row = [pa.array([feature], pa.int32()), pa.array([at], pa.int32()), pa.array([gain]), pa.array([kept.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["feature", "bin", "gain", "sums"])

            for batch in batches:
                for f, data in zip(batch.column("feature").to_pylist(), batch.column("sums").to_pylist()):
                    values = np.frombuffer(data, np.float64)
                    if f == feature:
                        total = total + values
                        continue
                    yield from done()
                    feature, total = f, values
            yield from done()

        sent = state.mapInArrow(partial, "feature int, part int, sums binary")
        found = sent.repartition("feature").sortWithinPartitions("feature", "part").mapInArrow(meet, "feature int, bin int, gain double, sums binary").collect()
        for r in found:
            values = np.frombuffer(r["sums"], np.float64)
            if r["feature"] < 0:
                loss, weight = values
            elif r["bin"] >= 0:
                out.append(Border(r["gain"], r["feature"], r["bin"], values.reshape(2, nodes, 2, classes)))
    return out, loss, weight


class SoftmaxBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol):
    """Boosted symmetric trees for any number of classes.

    ``iterations`` rounds with steps of ``learningRate``, trees of ``maxDepth`` levels, ``l2`` added to the curvature of
    a leaf, ``bins`` per feature (up to 256). Rows with a null label or vector are left out of the fit, a null vector gets
    a null prediction, and NaN falls into the first bin. Ties between borders go to the lowest feature and bin.
    """

    iterations = Param(Params._dummy(), "iterations", "rounds", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "step", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "added to the curvature of a leaf", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", weightCol=None,
        iterations=100, learningRate=0.1, maxDepth=6, l2=3.0, bins=32,
    ):
        super().__init__()
        self._setDefault(iterations=100, learningRate=0.1, maxDepth=6, l2=3.0, bins=32)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostingModel:
        get = self.getOrDefault
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        filled = dataset.where(F.col(self.getFeaturesCol()).isNotNull() & F.col(self.getLabelCol()).isNotNull())
        rows = filled.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"), weight.alias("weight"))
        rows = settled(balanced(rows))
        shares = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        if not shares:
            raise ValueError("no labelled rows")
        classes, total = max(shares) + 1, sum(shares.values())
        start = np.log(np.maximum([shares.get(k, 0.0) / total for k in range(classes)], 1e-9))
        width = len(rows.select("x").first()["x"])
        borders = quantile_borders(rows, "x", width, min(get("bins"), 256))
        trees, losses = grow(rows, borders, start, get("iterations"), get("maxDepth"), get("learningRate"), get("l2"))
        return self._copyValues(SoftmaxBoostingModel(borders, trees, start, losses))


def grow(
    rows: DataFrame, borders: list[np.ndarray], start: np.ndarray, iterations: int, depth: int, rate: float, l2: float
) -> tuple[list[Tree], list[float]]:
    """Trees, and the mean loss before the first and after each of them."""
    sizes, classes = [len(b) + 1 for b in borders], len(start)
    state = state_of(rows, borders, start)
    trees: list[Tree] = []
    pending: list[Tree] = []
    losses: list[float] = []
    for number in range(iterations + 1):
        tree, last = Tree(), None
        for level in range(depth if number < iterations else 1):
            found, loss, weight = best_borders(state, pending, tree, sizes, classes, l2)
            if not level:
                losses.append(loss / weight)
            best = min(found, key=lambda b: (-b.gain, b.feature), default=None)
            if best is None or best.gain <= 1e-12 or number == iterations:
                break
            tree.features.append(best.feature)
            tree.bins.append(best.bin)
            last = best
        if last is None:
            break
        sums = last.sums.reshape(-1, 2, classes)  # left leaves, then right ones: the new bit is the highest
        tree.values = -rate * sums[:, 0] / (sums[:, 1] + l2)
        trees.append(tree)
        pending.append(tree)
        if len(pending) == REFRESH:
            state, pending = refreshed(state, len(sizes), pending), []
    return trees, losses


class SoftmaxBoostingModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol, MLWritable, MLReadable):
    """Borders, trees and first scores; ``losses`` are the mean training losses before and after each round."""

    iterations, learningRate, maxDepth = SoftmaxBoosting.iterations, SoftmaxBoosting.learningRate, SoftmaxBoosting.maxDepth
    l2, bins = SoftmaxBoosting.l2, SoftmaxBoosting.bins

    def __init__(self, borders: list[np.ndarray], trees: list[Tree], start: np.ndarray, losses: list[float]):
        super().__init__()
        self._setDefault(iterations=100, learningRate=0.1, maxDepth=6, l2=3.0, bins=32)
        self.borders, self.trees, self.start, self.losses = borders, trees, start, losses

    def _transform(self, dataset: DataFrame) -> DataFrame:
        borders, trees, start = self.borders, self.trees, self.start

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(x), dtype=object)
            filled = np.flatnonzero(x.notna())
            if len(filled):
                codes = coded(np.array(x.iloc[filled].tolist(), np.float64).reshape(len(filled), -1), borders)
                found = softmax(raised(np.tile(start, (len(filled), 1)), codes, trees))
                out.iloc[filled] = pd.Series(list(found), dtype=object)
            return out

        vector = F.col(self.getFeaturesCol())
        out = dataset.withColumn("_p", shares(F.when(vector.isNotNull(), vector_to_array(vector))))
        top = F.array_position("_p", F.array_max("_p")) - 1
        probability = F.when(F.col("_p").isNotNull(), array_to_vector("_p"))
        return out.withColumns({self.getProbabilityCol(): probability, self.getPredictionCol(): top.cast("double")}).drop("_p")

    def table(self, spark) -> DataFrame:
        rows = [("start", self.start.tolist()), ("losses", self.losses)]
        rows += [(f"border {k}", b.tolist()) for k, b in enumerate(self.borders)]
        rows += [(f"tree {k}", [t.features, t.bins, t.values.tolist()]) for k, t in enumerate(self.trees)]
        return spark.createDataFrame([(k, json.dumps(v)) for k, v in rows], "name string, content string")

    @classmethod
    def from_table(cls, table: DataFrame) -> SoftmaxBoostingModel:
        found = {r["name"]: json.loads(r["content"]) for r in table.collect()}
        numbered = {kind: [found[f"{kind} {k}"] for k in range(sum(n.startswith(f"{kind} ") for n in found))] for kind in ("border", "tree")}
        trees = [Tree(f, b, np.array(v)) for f, b, v in numbered["tree"]]
        return cls([np.array(b, np.float64) for b in numbered["border"]], trees, np.array(found["start"]), found["losses"])

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)
