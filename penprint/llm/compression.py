"""Quality by compression: the dictionary that fits a text better tells its class."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm.common import bounded
from penprint.llm.labelled import drawn, remainder_is, sigmoid, texts_of

DICTIONARY = 64 << 10
BLOCK = 1024  # bytes compressed at a time, so that the dictionary and not the text's own past explains a block
LEVEL = 3
LEARN, CALIBRATE = 4000, 6000
PIECES = 4
THRESHOLD = 0.3


class Sizes:
    """Compressed sizes under the dictionaries of good and bad texts."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def compressor(content: bytes):
            known = zstandard.ZstdCompressionDict(content) if content else None
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)

        self.good, self.bad = compressor(good).compress, compressor(bad).compress

    def difference(self, text: bytes) -> float:
        """(bytes with the bad dictionary - bytes with the good one) per byte of the whole text; empty texts give 0."""
        view, saved = memoryview(text), 0
        for at in range(0, len(view), BLOCK):
            block = view[at : at + BLOCK]
            saved += len(self.bad(block)) - len(self.good(block))
        return saved / len(view) if len(view) else 0.0


def pieces(docs: DataFrame) -> list[bytes]:
    """Pieces of the sampled texts to train a dictionary on: up to ``PIECES`` blocks spread evenly over each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            out = []
            for text in batch.column("text").to_pylist():
                data = (text or "").encode()
                blocks = -(-len(data) // BLOCK)
                for k in range(min(PIECES, blocks)):
                    at = (k * blocks // min(PIECES, blocks)) * BLOCK
                    out.append(data[at : at + BLOCK])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["piece"])

    return sorted(row["piece"] for row in docs.select("text").mapInArrow(cut, "piece binary").collect())


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples make one of their raw bytes."""
    import zstandard

    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def measured(docs: DataFrame, model: tuple[bytes, bytes], column: str) -> DataFrame:
    """Add the normalised size difference; null texts count as empty, other columns pass unchanged."""
    from pyspark.sql.types import DoubleType, StructType

    content = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(column)
    schema = StructType(list(rest.schema.fields)).add(column, DoubleType())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(*content.value)
        for batch in bounded(batches):
            value = [sizes.difference((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64())], [*batch.schema.names, column])

    return rest.mapInArrow(measure, schema)


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve (Newton steps, a weak prior on the slope)."""
    scale = float(np.std(x)) or 1.0
    z = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(z @ w)
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6])
        w -= np.linalg.solve(hess, z.T @ (p - y) + np.array([1e-2, 1e-6]) * w)
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, divisor: int = 5, held: int = 0, learn: int = LEARN, calibrate: int = CALIBRATE):
    """Dictionaries from at most ``learn`` texts of each class, calibration on at most ``calibrate`` further draws.

    Only ids outside the held-out remainder are read; the draws follow a hash of the id. A class without texts has an
    empty dictionary; without labels every score is 0.5.
    """
    usable = ~remainder_is("doc_id", divisor, held)
    marks = labels.where(usable & F.col("quality").isNotNull()).select("doc_id", "quality").distinct()
    good, bad = (dictionary(pieces(texts_of(docs, drawn(marks.where(F.col("quality") == q), learn)))) for q in (1, 0))
    ids = drawn(marks, calibrate, seed=8)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = measured(rows, (good, bad), "difference").join(F.broadcast(marks.join(ids, "doc_id")), "doc_id")
    found = sorted((r["difference"], r["quality"]) for r in rows.select("difference", "quality").collect())
    if len({q for _, q in found}) < 2:
        only = {0: -4.0, 1: 4.0}.get(found[0][1] if found else None, 0.0)
        return (good, bad), (0.0, only)
    return (good, bad), calibrated(np.array([x for x, _ in found]), np.array([q for _, q in found], float))


def scored(docs: DataFrame, model, column: str = "quality_score") -> DataFrame:
    """Add the calibrated probability of good quality of the whole text."""
    contents, (slope, intercept) = model
    value = 1.0 / (1.0 + F.exp(-(F.col(column) * slope + intercept)))
    return measured(docs, contents, column).withColumn(column, value)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = scored(docs, fit(docs, labels), "score")
    return out.select(
        "doc_id",
        remainder_is("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
