"""A classifier head on dense vectors: one hidden layer with ReLU and dropout, class-weighted loss, AdamW.

A step is one pass over the rows of a mini-batch: tasks add up gradients, blocks of them meet in other tasks, and what
comes to the driver has the size of the layers, whatever the number of rows or partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.boosting import softmax
from penprint.operators.scale import balanced, settled
from penprint.operators.vectors import TableReader, TableWriter, class_weights

BLOCK = 1 << 16  # numbers of a block of gradients
PART_BYTES = 8 << 20  # vectors of a partition, at least
Layers = list[np.ndarray]  # weights and biases of both layers


def unrolled(layers: Layers) -> np.ndarray:
    return np.concatenate([x.ravel() for x in layers])


def rolled(flat: np.ndarray, shapes: list[tuple]) -> Layers:
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [part.reshape(s) for part, s in zip(np.split(flat, ends[:-1]), shapes)]


def kept_units(keys: np.ndarray, units: int, epoch: int, dropout: float) -> np.ndarray:
    """Which hidden units of each row stay in an epoch; it depends on the row's key alone."""
    if dropout <= 0:
        return np.ones((len(keys), units))
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(units, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        h = h + np.uint64(epoch + 1) * np.uint64(0xBF58476D1CE4E5B9)
        for _ in range(2):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    chance = (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return (chance >= dropout) / (1 - dropout)


def loss_and_gradients(layers: Layers, x: np.ndarray, labels: np.ndarray, weights: np.ndarray, mask: np.ndarray) -> tuple[float, Layers]:
    """Weighted sum of the negative log-likelihoods, and its derivatives."""
    w1, b1, w2, b2 = layers
    inner = x @ w1 + b1
    hidden = np.maximum(inner, 0) * mask
    p = softmax(hidden @ w2 + b2)
    rows = np.arange(len(labels))
    loss = -float((np.log(np.maximum(p[rows, labels], 1e-300)) * weights).sum())
    p[rows, labels] -= 1
    out = p * weights[:, None]
    back = (out @ w2.T) * mask * (inner > 0)
    return loss, [x.T @ back, back.sum(0), hidden.T @ out, out.sum(0)]


def opened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(batch.num_rows, -1)
    return x, np.asarray(batch.column("label")), np.asarray(batch.column("weight")), np.asarray(batch.column("key"))


def gradient_pass(rows: DataFrame, layers: Layers, epoch: int, dropout: float) -> tuple[float, float, np.ndarray]:
    """Loss, weight and gradients of all rows, the latter as one flat array."""
    shapes = [x.shape for x in layers]
    size = sum(x.size for x in layers)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, lost = np.zeros(size), np.zeros(2)
        for batch in batches:
            if batch.num_rows:
                x, labels, weights, keys = opened(batch)
                loss, grads = loss_and_gradients(layers, x, labels, weights, kept_units(keys, shapes[1][0], epoch, dropout))
                flat += unrolled(grads)
                lost += [loss, weights.sum()]
        if not lost[1]:
            return
        data = [lost.tobytes(), *[flat[low : low + BLOCK].tobytes() for low in range(0, size, BLOCK)]]
        part = [TaskContext.get().partitionId()] * len(data)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(data)), pa.int32()), pa.array(part, pa.int32()), pa.array(data, pa.binary())], ["block", "part", "sums"])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                values = np.frombuffer(data, np.float64)
                sums[block] = sums[block] + values if block in sums else values
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "sums"])

    sent = rows.mapInArrow(partial, "block int, part int, sums binary")
    met = sent.repartition("block").sortWithinPartitions("block", "part").mapInArrow(meet, "block int, sums binary").collect()
    parts = {r["block"]: np.frombuffer(r["sums"], np.float64) for r in met}
    if not parts:
        return 0.0, 0.0, np.zeros(size)
    loss, weight = parts.pop(0)
    return float(loss), float(weight), np.concatenate([parts[k] for k in sorted(parts)])


def mean_loss(rows: DataFrame, layers: Layers) -> float:
    """Weighted mean of the negative log-likelihoods, without dropout."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.zeros(2)
        for batch in batches:
            if batch.num_rows:
                x, labels, weights, _ = opened(batch)
                p = softmax(np.maximum(x @ layers[0] + layers[1], 0) @ layers[2] + layers[3])
                lost += [-(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)) * weights).sum(), weights.sum()]
        yield pa.RecordBatch.from_arrays([pa.array([lost[0]]), pa.array([lost[1]])], ["loss", "weight"])

    row = rows.mapInArrow(run, "loss double, weight double").agg(F.sum("loss").alias("loss"), F.sum("weight").alias("weight")).first()
    return row["loss"] / row["weight"] if row["weight"] else float("nan")


class AdamW:
    """Steps with running first and second moments and decay of the weights themselves."""

    def __init__(self, rate: float, decay: float, size: int):
        self.rate, self.decay, self.t = rate, decay, 0
        self.first, self.second = np.zeros(size), np.zeros(size)

    def step(self, flat: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.999 * self.second + 0.001 * gradient**2
        move = (self.first / (1 - 0.9**self.t)) / (np.sqrt(self.second / (1 - 0.999**self.t)) + 1e-8)
        return flat * (1 - self.rate * self.decay) - self.rate * move


class ReluHead(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    """The head as a pipeline stage.

    Rows go to the ``batches`` of an epoch by a hash of their vector and the epoch, so a rerun or another partitioning
    takes the same steps. With ``balanced`` a row's loss is weighted by rows / (classes * rows of its class). After every
    epoch the loss of the rows with a true ``validCol`` is taken, and the layers of the lowest are kept; without such
    rows those of the last epoch. Rows with a null vector or label are left out; a null vector gets a null prediction.
    """

    hidden = Param(Params._dummy(), "hidden", "hidden units", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes over all rows", TypeConverters.toInt)
    batches = Param(Params._dummy(), "batches", "steps of an epoch", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    decay = Param(Params._dummy(), "decay", "weight decay", TypeConverters.toFloat)
    dropout = Param(Params._dummy(), "dropout", "share of hidden units left out", TypeConverters.toFloat)
    balanced = Param(Params._dummy(), "balanced", "weight classes alike", TypeConverters.toBoolean)
    validCol = Param(Params._dummy(), "validCol", "marks the validation rows", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=42,
        hidden=512, epochs=10, batches=8, rate=1e-3, decay=0.01, dropout=0.1, balanced=True, validCol=None,
    ):
        super().__init__()
        self._setDefault(seed=42, hidden=512, epochs=10, batches=8, rate=1e-3, decay=0.01, dropout=0.1, balanced=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _state(self, dataset: DataFrame) -> tuple[DataFrame, int, int]:
        vector, label = F.col(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("int")
        valid = F.coalesce(F.col(self.getOrDefault("validCol")), F.lit(False)) if self.isSet(self.validCol) else F.lit(False)
        rows = dataset.where(vector.isNotNull() & label.isNotNull())
        rows = settled(balanced(rows.select(vector_to_array(vector).alias("v"), label.alias("label"), valid.alias("valid"))))
        weights = settled(class_weights(rows.where("NOT valid"), "label").select("label", "weight"))
        classes = rows.agg(F.max("label")).first()[0]
        if classes is None:
            raise ValueError("no labelled rows")
        if self.getOrDefault("balanced"):
            rows = rows.join(F.broadcast(weights), "label", "left").na.fill(0.0, ["weight"])
        else:
            rows = rows.withColumn("weight", F.lit(1.0))
        width = len(rows.select("v").first()["v"])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.asarray(batch.column("v").flatten(), np.float64).reshape(batch.num_rows, -1)
                packed = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "label", "weight", "valid")] + [packed], ["key", "label", "weight", "valid", "x"])

        keyed = rows.select(F.xxhash64("v").alias("key"), "label", "weight", "valid", "v")
        parts = rows.count() * width * 8 // PART_BYTES + 1
        state = settled(keyed.coalesce(parts).mapInArrow(run, "key bigint, label int, weight double, valid boolean, x binary"))
        return state, width, classes + 1

    def _fit(self, dataset: DataFrame) -> ReluHeadModel:
        get = self.getOrDefault
        state, width, classes = self._state(dataset)
        rng = np.random.default_rng(get("seed"))
        shapes = [(width, get("hidden")), (get("hidden"),), (get("hidden"), classes), (classes,)]
        bounds = [width**-0.5, width**-0.5, get("hidden") ** -0.5, get("hidden") ** -0.5]
        flat = np.concatenate([rng.uniform(-b, b, int(np.prod(s))) for b, s in zip(bounds, shapes)])
        train, valid = state.where("NOT valid"), state.where("valid")
        judged = valid.limit(1).count() > 0
        optimiser = AdamW(get("rate"), get("decay"), len(flat))
        best, lowest, losses = flat, float("inf"), []
        for epoch in range(get("epochs")):
            lost = total = 0.0
            for number in range(get("batches")):
                part = train.where(F.pmod(F.xxhash64("key", F.lit(epoch)), F.lit(get("batches"))) == number)
                loss, weight, gradient = gradient_pass(part, rolled(flat, shapes), epoch, get("dropout"))
                if weight:
                    flat = optimiser.step(flat, gradient / weight)
                    lost, total = lost + loss, total + weight
            found = mean_loss(valid, rolled(flat, shapes)) if judged else float("nan")
            losses.append((lost / max(total, 1e-300), found))
            if not judged or found < lowest:
                best, lowest = flat, found
        return self._copyValues(ReluHeadModel(rolled(best, shapes), losses))


class ReluHeadModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed, MLWritable, MLReadable):
    """The kept layers; ``losses`` has (train, validation) per epoch."""

    hidden, epochs, batches, rate, decay = ReluHead.hidden, ReluHead.epochs, ReluHead.batches, ReluHead.rate, ReluHead.decay
    dropout, balanced, validCol = ReluHead.dropout, ReluHead.balanced, ReluHead.validCol

    def __init__(self, layers: Layers, losses: list[tuple[float, float]]):
        super().__init__()
        self._setDefault(seed=42, hidden=512, epochs=10, batches=8, rate=1e-3, decay=0.01, dropout=0.1, balanced=True)
        self.layers, self.losses = layers, losses

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w1, b1, w2, b2 = self.layers

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(x), dtype=object)
            filled = np.flatnonzero(x.notna())
            if len(filled):
                rows = np.array(x.iloc[filled].tolist(), np.float64).reshape(len(filled), -1)
                out.iloc[filled] = pd.Series(list(softmax(np.maximum(rows @ w1 + b1, 0) @ w2 + b2)), dtype=object)
            return out

        vector = F.col(self.getFeaturesCol())
        out = dataset.withColumn("_p", shares(F.when(vector.isNotNull(), vector_to_array(vector))))
        top = F.array_position("_p", F.array_max("_p")) - 1
        probability = F.when(F.col("_p").isNotNull(), array_to_vector("_p"))
        return out.withColumns({self.getProbabilityCol(): probability, self.getPredictionCol(): top.cast("double")}).drop("_p")

    def table(self, spark) -> DataFrame:
        rows = [(k, json.dumps(list(x.shape)), x.ravel().tolist()) for k, x in enumerate(self.layers)]
        rows.append((len(self.layers), json.dumps([len(self.losses), 2]), [float(v) for pair in self.losses for v in pair]))
        return spark.createDataFrame(rows, "place int, shape string, numbers array<double>")

    @classmethod
    def from_table(cls, table: DataFrame) -> ReluHeadModel:
        rows = sorted(table.collect(), key=lambda r: r["place"])
        *layers, losses = [np.array(r["numbers"]).reshape(json.loads(r["shape"])) for r in rows]
        return cls(layers, [tuple(x) for x in losses.tolist()])

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)
