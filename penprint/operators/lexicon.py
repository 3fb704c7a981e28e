"""Lemma, part-of-speech and grammar lookups as joins with a lexicon table.

A lexicon has one row per word form: form, lemma, tag, gr.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.scale import balanced, lookup_join, settled, unnest, word_join

LEXICON_COLUMNS = ["form", "lemma", "tag", "gr"]


def build_lexicon(tagged: DataFrame) -> DataFrame:
    """Most frequent reading per form of a tagged token table (form, lemma, tag, gr)."""
    reading = F.struct("lemma", "tag", "gr")
    counted = tagged.groupBy("form", reading.alias("r")).agg(F.count("*").alias("n"))
    best = counted.groupBy("form").agg(F.max_by("r", F.struct("n", "r")).alias("r"))
    return best.select("form", "r.lemma", "r.tag", "r.gr")


def synthetic_lexicon(df: DataFrame, text: str = "text", pattern: str = fixed.ANY_WORD) -> DataFrame:
    """A made-up lexicon over the vocabulary of a corpus, for data without a real one.

    The lemma drops a final ``s``; the tag follows from the word length. It tests
    the joins and says nothing about the language.
    """
    forms = unnest(balanced(df), [], T.word_tokens(text, pattern), "form").distinct()
    tags = F.array(*[F.lit(t) for t in fixed.RATIO_TAGS])
    tag = F.element_at(tags, F.length("form") % 8 + 1)
    gr = F.concat(tag, F.lit(",n"), (F.length("form") % 3).cast("string"), F.lit("=x"))
    lemma = F.regexp_replace("form", "(.)s$", "$1")
    return settled(forms.select("form", lemma.alias("lemma"), tag.alias("tag"), gr.alias("gr")))


def token_rows(
    df: DataFrame, tokens: Column, keep: list[str], keep_empty: bool = False
) -> DataFrame:
    """One row per token: the kept columns, pos, token.

    ``keep_empty`` leaves one row with nulls for a text without tokens.
    """
    if not keep_empty:
        return unnest(df, keep, tokens, "token", "pos")
    return df.select(*keep, F.posexplode_outer(tokens).alias("pos", "token"))


def with_lexicon(rows: DataFrame, lexicon: DataFrame, columns: list[str], by: Sequence[str] = ()) -> DataFrame:
    """Add lexicon columns to token rows; unknown forms get nulls. ``by``: what the rows are partitioned by."""
    table = lexicon.select("form", *columns)
    return word_join(rows.withColumn("form", F.lower("token")), table, "form", by).drop("form")


def drop_listed(rows: DataFrame, stop: DataFrame) -> DataFrame:
    """Token rows without those of a stop table (column ``token``)."""
    marked = stop.select("token", F.lit(True).alias("_stop")).distinct()
    spread = [c for c in rows.columns if c != "token"]
    joined = lookup_join(rows, marked, ["token"], "left", salt_on=spread)
    return joined.where(F.col("_stop").isNull()).drop("_stop")


def in_order(value: Column, position: Column | str = "pos") -> Column:
    """Aggregate to the values of one text in token order, as an array."""
    pair = F.struct(F.col(position).alias("p"), value.alias("v"))
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), pair)))
    return F.transform(pairs, lambda p: p.v)


def lemma_column() -> Column:
    return F.coalesce(F.col("lemma"), F.col("token"))


def lemmatize(
    df: DataFrame, lexicon: DataFrame, tokens: Column, doc: str, out: str = "lemmas"
) -> DataFrame:
    """Lemmas of every text in token order; unknown forms stay.

    Texts are hash-partitioned by document while still compact, so the regroup
    after the broadcast lookup needs no second shuffle.
    """
    rows = token_rows(df.repartition(doc), tokens, [doc], keep_empty=True)
    known = with_lexicon(rows, lexicon, ["lemma"], by=[doc])
    return known.groupBy(doc).agg(in_order(lemma_column()).alias(out))


def grammar_codes(
    df: DataFrame,
    lexicon: DataFrame,
    doc: str,
    text: str = "text",
    full: bool = True,
    scheme: str | None = "core",
    alphabet: str = "а-яА-ЯёЁ",
    out: str = "codes",
) -> DataFrame:
    """Every word becomes its grammar tag, every mark its code; unknown words go.

    ``full=False`` cuts the tag at its first ``=``. ``scheme=None`` leaves marks
    uncoded, so they are dropped.
    """
    cleaned = T.clean_sentence(text, alphabet)
    codes = []
    if scheme is not None:
        cleaned = T.encode_punct(cleaned, scheme)
        codes = [code for _, code in fixed.MARK_CODES[scheme]] + [fixed.FREE_DASH_CODE[scheme]]
    tokens = T.extract_all(cleaned, rf"[{alphabet}A-Z]+(?:-[{alphabet}A-Z]+)*")
    rows = token_rows(df.repartition(doc), tokens, [doc], keep_empty=True)
    known = with_lexicon(rows, lexicon, ["gr"], by=[doc])
    gr = F.col("gr") if full else T.brief_grammar("gr")
    code = F.when(F.col("token").isin(codes), F.col("token")).otherwise(gr) if codes else gr
    coded = known.withColumn("code", code)
    return coded.groupBy(doc).agg(F.array_join(in_order(F.col("code")), " ").alias(out))


def flatten_morphology(df: DataFrame, doc: str, morph: str = "morph") -> DataFrame:
    """Token rows (doc, pos, token, gr) with the first reading of nested analyser output.

    ``morph`` is an array of (text, analysis array of (gr)); tokens without a
    reading have a null ``gr``.
    """
    rows = unnest(df, [doc], F.col(morph), "m", "pos")
    first = F.try_element_at(F.col("m.analysis"), F.lit(1))
    return rows.select(doc, "pos", F.col("m.text").alias("token"), first["gr"].alias("gr"))


def codes_from_morphology(
    df: DataFrame, doc: str, morph: str = "morph", full: bool = True, scheme: str = "core", out: str = "codes"
) -> DataFrame:
    """Grammar codes of analyser output: code words stay, other tokens give their tag."""
    codes = [code for _, code in fixed.MARK_CODES[scheme]] + [fixed.FREE_DASH_CODE[scheme]]
    gr = F.col("gr") if full else T.brief_grammar("gr")
    code = F.when(F.col("token").isin(codes), F.col("token")).otherwise(gr)
    rows = flatten_morphology(df, doc, morph)
    return rows.groupBy(doc).agg(F.array_join(in_order(code), " ").alias(out))


def morphology_tags(df: DataFrame, doc: str, morph: str = "morph") -> DataFrame:
    """Short and full tags per text from analyser output, tokens without a reading left out."""
    rows = flatten_morphology(df, doc, morph)
    tags = in_order(T.short_tag("gr")).alias("tags")
    return rows.groupBy(doc).agg(tags, in_order(F.col("gr")).alias("grams"))
