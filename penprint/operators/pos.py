"""Part-of-speech statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.lexicon import token_rows, with_lexicon
from penprint.operators.scale import balanced
from penprint.operators.stats import punct_to_word, sent_stats, sentence_rows, token_stats

POS_STATS = [
    "noun2verb", "adj2noun", "adv2verb", "pr2noun", "conj2noun", "pron2noun", "verb2word",
]


def tagged_words(
    df: DataFrame, lexicon: DataFrame, keep: list[str], text: str = "text",
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """One row per word with the tag of its lexicon entry, cut at ``=``.

    A text without words keeps one row with nulls.
    """
    rows = token_rows(balanced(df), T.word_tokens(text, pattern), keep, keep_empty=True)
    return with_lexicon(rows, lexicon, ["tag"]).withColumn("tag", T.brief_grammar("tag"))


def tag_counts(
    tagged: DataFrame, keys: list[str], tags: list[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Word count and one count column per tag, summed per key.

    ``keep`` names columns that are constant per key.
    """
    sums = [F.count_if(F.col("tag") == t).alias(f"tag_{t}") for t in tags]
    kept = [F.first(c).alias(c) for c in keep]
    return tagged.groupBy(*keys).agg(F.count("token").alias("n_tagged_words"), *sums, *kept)


def _share(top: Column, bottom: Column) -> Column:
    both = (top != 0) & (bottom != 0)
    return F.when(both, top.cast("double") / bottom).otherwise(F.lit(0.0))


def _ratios() -> dict[str, Column]:
    """The ratios over the columns of ``tag_counts``."""

    def n(tag: str) -> Column:
        return F.col(f"`tag_{tag}`")

    return {
        "noun2verb": _share(n("S"), n("V")),
        "adj2noun": _share(n("A"), n("S")),
        "adv2verb": _share(n("ADV"), n("V")),
        "pr2noun": _share(n("PR"), n("S")),
        "conj2noun": _share(n("CONJ"), n("S")),
        "pron2noun": _share(n("S-PRO") + n("A-PRO"), n("S")),
        "verb2word": _share(n("V"), F.col("n_tagged_words")),
    }


def pos_stats(
    df: DataFrame, lexicon: DataFrame, doc: str, text: str = "text",
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """Ratios between part-of-speech counts; zero where either side is zero."""
    return tag_ratios(tagged_words(df, lexicon, [doc], text, pattern), doc)


def tag_ratios(tagged: DataFrame, doc: str) -> DataFrame:
    """The ratios from rows (doc, token, tag)."""
    counted = tag_counts(tagged, [doc], fixed.RATIO_TAGS)
    return counted.select(doc, *[ratio.alias(name) for name, ratio in _ratios().items()])


def attach_features(df: DataFrame, features: DataFrame, doc: str) -> DataFrame:
    """Add feature columns to their rows, one to one by key."""
    return df.join(features, doc)


def text_stats(
    df: DataFrame,
    doc: str,
    text: str = "text",
    lexicon: DataFrame | None = None,
    sent: bool = True,
    tkn: bool = True,
    pos: bool = True,
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """The combined statistics: up to twenty columns per text.

    Texts are read and tokenised once: the tag counts travel with the other,
    already numeric statistics.
    """
    if not (sent or tkn or pos):
        raise ValueError("at least one group of statistics must be switched on")
    if pos and lexicon is None:
        raise ValueError("part-of-speech statistics need a lexicon")
    out = balanced(df.select(doc, text)) if pos else df
    if sent:
        out = sent_stats(out, text)
    if tkn or pos:
        out = out.withColumn("_tokens", T.word_tokens(text, pattern))
    if tkn:
        out = token_stats(out, tokens="_tokens")
    if sent and (tkn or pos):
        out = punct_to_word(out, "_tokens")
    else:
        out = out.withColumn("punct2word", F.lit(0.0))
    if not pos:
        return out.drop("_tokens")
    numbers = [c for c in out.columns if c not in (doc, text, "_tokens")]
    rows = token_rows(out, F.col("_tokens"), [doc, *numbers], keep_empty=True)
    tagged = with_lexicon(rows, lexicon, ["tag"]).withColumn("tag", T.brief_grammar("tag"))
    counted = tag_counts(tagged, [doc], fixed.RATIO_TAGS, keep=numbers)
    stats = counted.select(doc, *numbers, *[ratio.alias(name) for name, ratio in _ratios().items()])
    return attach_features(df, stats, doc)


def pos_shares_wide(
    df: DataFrame, lexicon: DataFrame, keep: list[str], tags: list[str], text: str = "text",
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """Share of each tag among the tagged words of a text, absent tags as zero."""
    counted = tag_counts(tagged_words(df, lexicon, keep, text, pattern), keep, tags)
    total = reduce(lambda a, b: a + b, [F.col(f"`tag_{t}`") for t in tags])
    shares = [
        F.when(total > 0, F.col(f"`tag_{t}`") / total).otherwise(0.0).alias(t) for t in tags
    ]
    return counted.select(*keep, *shares)


def pos_shares(
    df: DataFrame, lexicon: DataFrame, doc: str, text: str = "text",
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """Share per (text, tag), for any tag set, in long form."""
    tagged = tagged_words(df, lexicon, [doc], text, pattern).where(F.col("tag").isNotNull())
    counted = tagged.groupBy(doc, "tag").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(doc))
    return counted.withColumn("share", F.col("n") / total)


def pos_examples(
    df: DataFrame, lexicon: DataFrame, doc: str, k: int = 5, text: str = "text",
    pattern: str = fixed.CYRILLIC_WORD,
) -> DataFrame:
    """The first ``k`` different words of every tag, in order of appearance.

    First places are found per word before ranking, and the rank filter lets
    Spark keep only ``k`` rows per tag and task before the shuffle.
    """
    tagged = tagged_words(df, lexicon, [doc], text, pattern).where(F.col("tag").isNotNull())
    first = tagged.groupBy("tag", "token").agg(F.min(F.struct(doc, "pos")).alias("place"))
    order = Window.partitionBy("tag").orderBy("place")
    return first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pos_profile(
    df: DataFrame,
    lexicon: DataFrame,
    author: str,
    tags: list[str] = fixed.PROFILE_TAGS,
    text: str = "text",
    alphabet: str = "а-яА-ЯёЁ",
) -> DataFrame:
    """Mean count of each tag per (author, sentence length), in long form.

    One pass counts words per tag and, by their first words, sentences; no
    sentence has to be regrouped from its tokens. Unknown tags are ignored.
    """
    sents = sentence_rows(balanced(df).select(author, text), text).withColumnRenamed("pos", "place")
    words = T.extract_all(T.strip_for_morph("sentence", alphabet), rf"[{alphabet}]+(?:-[{alphabet}]+)*")
    rows = token_rows(sents, words, [author, "n_words", "place"], keep_empty=True)
    tagged = with_lexicon(rows, lexicon, ["gr"]).withColumn("tag", T.short_tag("gr"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    cells = tagged.groupBy(author, "n_words", "tag").agg(
        F.count("*").alias("n"), F.count_if(first).alias("firsts")
    )
    per_tag = F.collect_list(F.when(F.col("tag").isin(tags), F.struct("tag", "n")))
    totals = cells.groupBy(author, "n_words").agg(
        F.sum("firsts").alias("n_sents"), F.map_from_entries(per_tag).alias("counts")
    )
    grid = totals.withColumn("tag", F.explode(F.array(*[F.lit(t) for t in tags])))
    found = F.coalesce(F.try_element_at("counts", F.col("tag")), F.lit(0))
    return grid.withColumn("mean_count", found / F.col("n_sents")).drop("counts")
