"""Per-author profiles and corpus summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import fixed
from penprint.operators.pos import pos_shares_wide
from penprint.operators.scale import exact_quantiles, settled
from penprint.operators.stats import BASIC_STATS, sentence_rows, sentence_stats


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, absolute and as a share, most frequent first."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("share", share).orderBy(F.desc("n"), label)


def profile_mean(stats: DataFrame, author: str, columns: Sequence[str] = BASIC_STATS) -> DataFrame:
    return stats.groupBy(author).agg(*[F.avg(c).alias(c) for c in columns])


def profile_median(
    stats: DataFrame, author: str, columns: Sequence[str] = BASIC_STATS, width: float = 1.0
) -> DataFrame:
    """Exact medians per author, one column per statistic."""
    long = exact_quantiles(stats, [author], columns, 0.5, width)
    return wide(long, author, columns)


def wide(long: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    picked = [F.max(F.when(F.col("stat") == c, F.col("value"))).alias(c) for c in columns]
    return long.groupBy(key).agg(*picked)


def pos_median_profile(
    df: DataFrame, lexicon: DataFrame, doc: str, author: str, tags: Sequence[str],
    text: str = "text", pattern: str = fixed.CYRILLIC_WORD, width: float = 1 / 1024,
) -> DataFrame:
    """Median tag share per author and overall, tags ordered by their mean of means.

    Returns author, tag, tag_rank, median_share, global_median.
    """
    tags = list(tags)
    shares = settled(pos_shares_wide(df, lexicon, [author, doc], tags, text, pattern).drop(doc))
    by_author = exact_quantiles(shares, [author], tags, 0.5, width)
    overall = exact_quantiles(shares.withColumn("_all", F.lit(0)), ["_all"], tags, 0.5, width)
    means = shares.groupBy(author).agg(*[F.avg(t).alias(t) for t in tags])
    centre = means.agg(*[F.avg(t).alias(t) for t in tags])
    pairs = F.array(*[F.struct(F.lit(t).alias("stat"), F.col(t).alias("m")) for t in tags])
    ranks = centre.select(F.explode(pairs).alias("p")).select("p.*")
    ranks = ranks.withColumn(
        "tag_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("m"), "stat"))
    )
    return (
        by_author.withColumnRenamed("value", "median_share")
        .join(F.broadcast(overall.select("stat", F.col("value").alias("global_median"))), "stat")
        .join(F.broadcast(ranks.select("stat", "tag_rank")), "stat")
        .select(author, F.col("stat").alias("tag"), "tag_rank", "median_share", "global_median")
    )


def sentence_length_dist(
    df: DataFrame, author: str, lo: int = 1, hi: int = 15, text: str = "text"
) -> DataFrame:
    """Share of each sentence length among all sentences of an author.

    Lengths are placed by rising order from zero; places ``lo`` to ``hi - 1``
    are shown, so the shortest length drops out by default.
    """
    sents = sentence_rows(df.select(author, text), text)
    counted = sents.groupBy(author, "n_words").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(author)
    counted = counted.withColumn("freq", F.col("n") / F.sum("n").over(whole))
    place = F.row_number().over(whole.orderBy("n_words")) - 1
    return counted.withColumn("place", place).where((F.col("place") >= lo) & (F.col("place") < hi))


def punct_profile(df: DataFrame, author: str, text: str = "text") -> DataFrame:
    """Mean marks per (author, sentence length)."""
    stats = sentence_stats(df.select(author, text), text)
    means = [F.avg(name).alias(name) for name in fixed.SENTENCE_MARKS.values()]
    return stats.groupBy(author, "n_words").agg(*means, F.count("*").alias("n_sents"))


def at_lengths(profile: DataFrame, lengths: Sequence[int] = fixed.PROFILE_LENGTHS) -> DataFrame:
    """The rows of a profile that a report shows."""
    return profile.where(F.col("n_words").isin(list(lengths)))


def books_per_author(df: DataFrame, author: str, book: str) -> DataFrame:
    """Different books per author; duplicates are dropped before counting."""
    return df.select(author, book).distinct().groupBy(author).agg(F.count("*").alias("n_books"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def confusion_wide(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    counted = df.groupBy(label).pivot(prediction, list(classes)).count()
    return counted.fillna(0)


def author_sentences(df: DataFrame, author: str, book: str, text: str = "text") -> DataFrame:
    """Sentence statistics of all books of an author: the author is a key column."""
    return sentence_stats(df.select(author, book, text), text)
