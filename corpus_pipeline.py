"""A corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing, token records.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; it is written as Parquet and reread as
the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from penprint.llm import decontaminate, mixing, near, records, toxicity
from penprint.llm.common import shared_folder, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model accepts; it is fitted on the labelled rows among ``docs``."""
    docs = docs.select(COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.scored(docs, model, "_toxicity").where(f"_toxicity < {toxicity.THRESHOLD}").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near.deduplicated(docs.select(COLUMNS)).select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no benchmark item is verified."""
    return decontaminate.decontaminated(docs.select(COLUMNS), spark.read.parquet(f"{folder}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents repeated so that the sources meet their target weights."""
    return mixing.mixed(docs.select(COLUMNS))


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token record files of the mix, read back: one row per record."""
    import public_tokenizers

    target = shared_folder(spark, "records")
    records.write_records(docs, target, public_tokenizers.path("byte_bpe_50k.json"))
    return records.read_records(spark, target, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: The toxicity model, signatures and tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
