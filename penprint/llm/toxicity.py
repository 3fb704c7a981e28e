"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm import words
from penprint.llm.common import bounded
from penprint.llm.labelled import drawn, remainder_is, sigmoid

SLOTS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8, 9)
POSITIVES, UNLABELLED = 4000, 8000
THRESHOLD = 0.3
CLEAR = 4.0  # standard errors between the classes that a feature must show to be used


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature slots of every row and their bounds: whole words and their first bytes, lower-cased."""
    data, bounds = words.flat(texts)
    begins, ends, rows = words.spans(data, bounds, words.MARKS)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(rows))
    slots, owners = [words.span_hashes(data, begins, ends)], [row]
    for k in PREFIXES:
        long = ends - begins > k
        slots.append(words.span_hashes(data, begins[long], begins[long] + k, salt=k))
        owners.append(row[long])
    keys = np.concatenate(owners).astype(np.int64) * SLOTS + (np.concatenate(slots) >> np.uint64(44)).astype(np.int64)
    keys = np.unique(keys)
    return (keys % SLOTS).astype(np.int32), np.searchsorted(keys, np.arange(len(bounds), dtype=np.int64) * SLOTS)


def hits(table: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Sum of the weights of each row's distinct features."""
    data, bounds = words.flat(texts)
    begins, ends, rows = words.spans(data, bounds, words.MARKS)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(rows))
    found = []
    for k in (0, *PREFIXES):
        long = ends - begins > k
        b = begins[long]
        slots = (words.span_hashes(data, b, b + k if k else ends[long], salt=k) >> np.uint64(44)).astype(np.int64)
        used = table[slots] != 0
        found.append(row[long][used].astype(np.int64) * SLOTS + slots[used])
    keys = np.unique(np.concatenate(found))
    return np.bincount(keys // SLOTS, weights=table[keys % SLOTS], minlength=len(bounds) - 1)


def screened(slots: np.ndarray, bounds: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Slots whose share among the positives and the unlabelled differs clearly."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n1, n0 = max(1, positive.sum()), max(1, (~positive).sum())
    c1 = np.bincount(slots[positive[row]], minlength=SLOTS)
    c0 = np.bincount(slots[~positive[row]], minlength=SLOTS)
    share = (c1 + c0 + 1.0) / (n1 + n0 + 2.0)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return np.flatnonzero((np.abs(c1 / n1 - c0 / n0) > CLEAR * error) & (c1 + c0 >= 3))


def fitted(slots: np.ndarray, bounds: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 400, seeds: int = 3) -> tuple[np.ndarray, float]:
    """Weights per slot and a bias that minimise the non-negative risk with logistic loss, averaged over ``seeds`` starts.

    The risk is prior * E+[l(g)] + max(0, Eu[l(-g)] - prior * E+[l(-g)]); while the second part is negative its
    gradient is reversed, which keeps a flexible model from fitting unlabelled positives as negatives.
    """
    chosen = screened(slots, bounds, positive)
    place = np.full(SLOTS, -1)
    place[chosen] = np.arange(len(chosen))
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = place[slots] >= 0
    row, column = row[inside], place[slots[inside]]
    n, n1, n0 = len(positive), max(1, positive.sum()), max(1, (~positive).sum())
    table, base = np.zeros(SLOTS), 0.0
    for seed in range(seeds):
        rng = np.random.default_rng(seed)
        w = np.append(rng.normal(0, 0.01, len(chosen)), np.log(prior / (1 - prior)))
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, rounds + 1):
            g = np.bincount(row, weights=w[column], minlength=n) + w[-1]
            p = sigmoid(g)
            negative = np.logaddexp(0, g)
            rest = negative[~positive].sum() / n0 - prior * negative[positive].sum() / n1
            sign = 1.0 if rest >= 0 else -1.0
            slope = np.where(positive, sign * -prior * p / n1 + (prior * (p - 1) / n1 if sign > 0 else 0.0), sign * p / n0)
            grad = np.append(np.bincount(column, weights=slope[row], minlength=len(chosen)), slope.sum()) + np.append(1e-4 * w[:-1], 0.0)
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        table[chosen] += w[:-1] / seeds
        base += w[-1] / seeds
    table = table.astype(np.float32)
    logits = np.bincount(row, weights=table[chosen][column], minlength=n)[~positive]
    return table, float(base) if not len(logits) else matched(logits, prior)


def matched(logits: np.ndarray, prior: float) -> float:
    """The bias with which the mean probability over unlabelled text equals the class prior."""
    low, high = -40.0 - logits.max(), 40.0 - logits.min()
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if sigmoid(logits + middle).mean() > prior else (middle, high)
    return (low + high) / 2


def fit(docs: DataFrame, labels: DataFrame, divisor: int = 4, held: int = 2, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample: at most ``positives`` confirmed toxic documents and ``unlabelled`` others.

    Only ids outside the held-out remainder are read. The unlabelled sample is drawn from all texts, whatever their
    label, so it holds toxic ones at the natural rate; the class prior is the share of toxic rows among the labelled.
    Documents, not occurrences, are counted, and the sample's features come to the driver as 4-byte slots of whole
    texts. Without any confirmed positive every document scores the prior of 0.
    """
    learn = ~remainder_is("doc_id", divisor, held)
    marks = labels.where(learn & F.col("toxic").isNotNull()).select("doc_id", "toxic").distinct()
    share = marks.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first()["p"]
    if not share:
        return np.zeros(SLOTS, np.float32), -40.0
    first = drawn(marks.where("toxic = 1"), positives).withColumn("positive", F.lit(True))
    other = drawn(docs.where(learn), unlabelled).withColumn("positive", F.lit(False))
    ids = first.unionByName(other)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 20):
            slots, bounds = features(batch.column("text"))
            rows = [slots[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(rows, pa.binary())], ["positive", "slots"])

    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("positive", "text")
    table = sample.mapInArrow(extract, "positive boolean, slots binary").toArrow()
    rows = table.column("slots").to_pylist()
    order = sorted(range(len(rows)), key=lambda i: rows[i])  # the same fit however the rows arrive
    positive = np.array(table.column("positive").to_pylist(), bool)[order]
    lists = [np.frombuffer(rows[i], np.int32) for i in order]
    if not positive.any() or positive.all():
        return np.zeros(SLOTS, np.float32), -40.0
    bounds = np.append(0, np.cumsum([len(x) for x in lists]))
    return fitted(np.concatenate(lists), bounds, positive, min(max(share, 0.001), 0.999))


def scored(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "toxicity") -> DataFrame:
    """Add the model's probability that the whole text is toxic. Null and empty texts score the bias alone.

    Rows and their other columns pass unchanged; a column of the same name is replaced.
    """
    from pyspark.sql.types import DoubleType, StructType

    table = docs.sparkSession.sparkContext.broadcast(model[0])
    base = model[1]
    rest = docs.drop(column)
    schema = StructType(list(rest.schema.fields)).add(column, DoubleType())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 20):
            value = sigmoid(hits(table.value, batch.column("text")) + base)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, column])

    return rest.mapInArrow(score, schema)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = scored(docs, fit(docs, labels), "score")
    return out.select(
        "doc_id",
        remainder_is("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
