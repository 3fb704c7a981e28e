"""Multinomial naive Bayes over long-form term counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.scale import lookup_join, settled, unnest


@dataclass
class NaiveBayesTable:
    """Class sizes (bounded by the number of classes) and weights per (term, class)."""

    classes: list[tuple]
    weights: DataFrame
    alpha: float
    n_terms: int


def fit(counts: DataFrame, doc_labels: DataFrame, doc: str, label: str, alpha: float = 1.0) -> NaiveBayesTable:
    """Learn from term counts that carry their label.

    A term's weights are stored only for the classes it was seen in, relative to
    an unseen term, so the table is as sparse as the corpus.
    """
    seen = settled(counts.groupBy("term", label).agg(F.sum("tf").alias("n")))
    sizes = doc_labels.groupBy(label).agg(F.count("*").alias("docs"))
    totals = seen.groupBy(label).agg(F.sum("n").alias("words"))
    rows = sizes.join(totals, label, "left").fillna(0).collect()  # a row per class
    classes = sorted((r[label], r["docs"], r["words"]) for r in rows)
    gain = F.log(F.col("n") + alpha) - F.log(F.lit(alpha))
    per_term = seen.groupBy("term").agg(
        F.collect_list(F.struct(F.col(label).alias("label"), gain.alias("gain"))).alias("gains")
    )
    weights = settled(per_term)
    return NaiveBayesTable(classes, weights, alpha, weights.count())


def scores(model: NaiveBayesTable, counts: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    """(doc, label, score): joint log likelihood; unknown terms are ignored.

    A document without known terms is scored by the class sizes alone.
    """
    known = lookup_join(counts, model.weights, ["term"], salt_on=[doc])
    label_type = known.schema["gains"].dataType.elementType["label"].dataType
    length = F.struct(F.lit(None).cast(label_type).alias("label"), F.lit(1.0).alias("gain"))
    sums = (
        unnest(known, [doc, "tf"], F.concat("gains", F.array(length)), "g")
        .groupBy(doc, F.col("g.label").alias("label"))
        .agg(F.sum(F.col("tf") * F.col("g.gain")).alias("gain"))
    )
    pair = F.when(F.col("label").isNotNull(), F.struct("label", "gain"))
    per_doc = sums.groupBy(doc).agg(
        F.max(F.when(F.col("label").isNull(), F.col("gain"))).alias("len"),
        F.map_from_entries(F.collect_list(pair)).alias("gains"),
    )
    n_docs = sum(docs for _, docs, _ in model.classes)
    classes = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.log(F.lit(docs / n_docs)).alias("prior"),
                (F.log(F.lit(model.alpha)) - F.log(F.lit(words + model.alpha * model.n_terms))).alias("base"),
            )
            for name, docs, words in model.classes
        ]
    )
    rows = docs.select(doc).join(per_doc, doc, "left").select(doc, "len", "gains", F.explode(classes).alias("c"))
    gain = F.coalesce(F.try_element_at("gains", F.col("c.label")), F.lit(0.0))
    total = F.col("c.prior") + F.coalesce("len", F.lit(0.0)) * F.col("c.base") + gain
    return rows.select(doc, F.col("c.label").alias("label"), total.alias("score"))


def predict(model: NaiveBayesTable, counts: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    best = F.max_by(F.struct("label", "score"), "score").alias("b")
    return scores(model, counts, docs, doc).groupBy(doc).agg(best).select(
        doc, F.col("b.label").alias("prediction"), F.col("b.score").alias("score")
    )
