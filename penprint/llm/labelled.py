"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.common import text_crc


def remainder_is(identity: str, divisor: int, value: int) -> Column:
    """Whether crc32(id as text) leaves ``value``; false for a null id."""
    return F.coalesce(text_crc(identity) % divisor == value, F.lit(False))


def drawn(ids: DataFrame, most: int, seed: int = 7) -> DataFrame:
    """At most ``most`` different ids, those with the smallest hash of id and seed."""
    order = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f"/{seed}")).cast("binary"))
    kept = ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return kept.orderBy(order, "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the drawn documents; ``ids`` is bounded by its draw."""
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")


def sigmoid(x):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
