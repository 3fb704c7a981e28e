"""Mixing sources to target weights by whole-document repetition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm.common import WORD, written
from penprint.operators.scale import dense_ids, lookup_join, running_totals

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240


def words_in(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Words that each source gives to the mix.

    ``sizes`` has one row per source: source, source_size. Sources in code point order, null last, get the weights in
    turn and share the total of all sizes; no target exceeds ``most`` times its source's size, and what is over goes
    to the others by weight. The shares that end this are ``min(most * size, level * weight)``: sources are put in the
    order in which they reach their limit, running sums give the level that would hold if all earlier ones were at
    their limit, and the first source that stays below its own fixes it. Empty tables give none; sources without words
    get 0. Adds weight, target, rate.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("_rank") % len(weights) + 1)
    ranked = (
        dense_ids(sizes, [F.col("source").asc_nulls_last()], "_rank")
        .withColumn("weight", weight)
        .drop("_rank")
        .withColumn("_limit", F.col("source_size") * most)
        .withColumn("_full", F.col("_limit") / F.col("weight"))
    )
    order = [F.col("_full").asc(), F.col("source").asc_nulls_last()]
    sums = running_totals(ranked, order, {"_limits": F.col("_limit"), "_weights": F.col("weight")})
    sums = written(sums, "mix-sums")
    total = sums.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = (F.lit(total["size"]) - F.col("_limits") + F.col("_limit")) / (
        F.lit(total["weight"]) - F.col("_weights") + F.col("weight")
    )
    first = sums.where(F.col("_full") >= level).agg(F.min(F.struct(F.col("_full"), level.alias("level")))["level"].alias("level")).first()
    level = F.lit(first["level"]).cast("double")
    target = F.least(F.col("_limit").cast("double"), F.coalesce(level * F.col("weight"), F.col("_limit").cast("double")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sums.withColumn("target", target)
        .withColumn("rate", rate)
        .select("source", "source_size", "weight", "target", "rate")
    )


def chance(identity: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(identity.cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def planned(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED, identity: str = "doc_id"
) -> DataFrame:
    """Every row of ``docs`` with the number of its copies in the mix.

    Adds mix_size (words), mix_source_size, mix_target (of its source) and mix_copies: the whole part of the source's
    repetition rate, and one more with the rate's fraction as probability, drawn from a hash of id and seed. Rows that
    share an id share the draw; a null source is a source, a null or empty text has size 0 and is kept with its copies;
    other columns pass unchanged.
    """
    sized = docs.withColumn("mix_size", words_in(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_key")
    table = source_targets(written(sizes, "mix-sizes"), weights, most)
    table = written(table.select(key, "source_size", "target", "rate"), "mix-rates")
    joined = lookup_join(
        sized.select("*", key),
        table.select("_key", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("rate").alias("_rate")),
        ["_key"],
        salt_on=[identity],
    )
    whole = F.floor("_rate")
    extra = (chance(F.col(identity), seed) < F.col("_rate") - whole).cast("bigint")
    return joined.withColumn("mix_copies", whole + extra).drop("_key", "_rate")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED, identity: str = "doc_id") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as planned."""
    plan = planned(docs, weights, most, seed, identity)
    times = F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int")))
    return plan.withColumn("_copy", times).select(*docs.columns)


def op4_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return planned(docs).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s
), c AS (SELECT *, source_size * 3 AS lim, (source_size * 3)::DOUBLE / weight AS full_at FROM w),
r AS (
  SELECT *, sum(lim) OVER o - lim AS before, sum(weight) OVER () - sum(weight) OVER o + weight AS open_weight,
         sum(source_size) OVER () AS total
  FROM c WINDOW o AS (ORDER BY full_at, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT (total - before)::DOUBLE / open_weight::DOUBLE AS level FROM r
  WHERE full_at >= (total - before)::DOUBLE / open_weight::DOUBLE ORDER BY full_at LIMIT 1
), t AS (
  SELECT source, source_size, least(lim::DOUBLE, coalesce((SELECT level FROM l) * weight, lim::DOUBLE)) AS target FROM c
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':20240'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""
