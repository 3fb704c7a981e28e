"""Row-local text statistics: no shuffle, no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.scale import unnest

SENT_STATS = [*fixed.TEXT_MARKS.values(), "avg_snt_len"]
TOKEN_STATS = ["avg_tkn_len", "ttr"]
BASIC_STATS = [
    "n_sents", "n_words", "n_unique_words", "n_long_words", "n_complex_words",
    "n_simple_words", "n_monosyllable_words", "n_polysyllable_words", "n_chars",
    "n_letters", "n_spaces", "n_syllables", "n_punctuations",
]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top.cast("double") / bottom).otherwise(F.lit(0.0))


def sent_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Mark counts and the mean sentence length in characters.

    The ellipsis takes its three dots, so only the remaining dots are periods.
    """
    counts = {name: T.occurrences(text, mark) for mark, name in fixed.TEXT_MARKS.items()}
    counts["period"] = counts["period"] - 3 * counts["ellipsis"]
    out = df.withColumns(counts)
    ends = F.col("period") + F.col("exclam") + F.col("question") + F.col("ellipsis")
    length = F.length(text).cast("double")
    return out.withColumn("avg_snt_len", F.when(ends > 0, length / ends).otherwise(length))


def token_stats(
    df: DataFrame, text: str = "text", pattern: str = fixed.CYRILLIC_WORD, tokens: str | None = None
) -> DataFrame:
    """Mean token length and type-token ratio; zero without tokens.

    ``tokens`` names a column that already holds the word tokens.
    """
    words = tokens or "_words"
    out = df if tokens else df.withColumn(words, T.word_tokens(text, pattern))
    total = F.size(words)
    out = out.withColumns(
        {
            "avg_tkn_len": _ratio(F.length(F.array_join(words, "")), total),
            "ttr": _ratio(F.size(F.array_distinct(words)), total),
        }
    )
    return out if tokens else out.drop(words)


def punct_to_word(df: DataFrame, tokens: str) -> DataFrame:
    """Marks per word, from the columns of ``sent_stats`` and the word tokens."""
    marks = sum((F.col(name) for name in fixed.TEXT_MARKS.values()), F.lit(0))
    return df.withColumn("punct2word", _ratio(marks, F.size(tokens)))


def text_profile(df: DataFrame, text: str = "text") -> DataFrame:
    """Characters, blank-separated words, and mean word and sentence length."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: F.length(w) > 0)
    out = df.withColumns({"_words": words, "_sents": T.sentences(text)})
    return out.withColumns(
        {
            "n_chars_total": F.length(text),
            "word_count": F.size("_words"),
            "mean_word_length": _ratio(F.length(F.array_join("_words", "")), F.size("_words")),
            "mean_sent_length": _ratio(F.length(F.array_join("_sents", "")), F.size("_sents")),
        }
    ).drop("_words", "_sents")


def basic_stats(
    df: DataFrame,
    text: str = "text",
    pattern: str = fixed.ANY_WORD,
    vowels: str = fixed.RUSSIAN_VOWELS,
    long_from: int = 6,
    complex_from: int = 4,
) -> DataFrame:
    """Thirteen counts per text; nulls where a text holds no word character.

    A syllable is a vowel. ``long_from`` letters make a long word and
    ``complex_from`` syllables a complex one.
    """
    out = df.withColumn("_w", T.word_tokens(text, pattern))
    syllables = F.transform(
        "_w", lambda w: F.length(w) - F.length(F.translate(w, vowels, ""))
    )
    out = out.withColumn("_syl", syllables)

    def words_where(rule) -> Column:
        return F.size(F.filter("_syl", rule))

    squeezed = F.replace(F.col(text), F.lit("\n"), F.lit(""))
    marks = F.translate(F.col(text), fixed.ASCII_MARKS + "«»—…№", "")
    counts = {
        "n_sents": F.size(T.sentences(text)),
        "n_words": F.size("_w"),
        "n_unique_words": F.size(F.array_distinct("_w")),
        "n_long_words": F.size(F.filter("_w", lambda w: F.length(w) >= long_from)),
        "n_complex_words": words_where(lambda s: s >= complex_from),
        "n_simple_words": words_where(lambda s: (s > 0) & (s < complex_from)),
        "n_monosyllable_words": words_where(lambda s: s == 1),
        "n_polysyllable_words": words_where(lambda s: s > 1),
        "n_chars": F.length(squeezed),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")),
        "n_spaces": T.occurrences(text, " "),
        "n_syllables": F.aggregate("_syl", F.lit(0), lambda a, s: a + s),
        "n_punctuations": F.length(text) - F.length(marks),
    }
    usable = F.col(text).rlike(r"[\p{L}\p{N}_]")
    guarded = {name: F.when(usable, value.cast("int")) for name, value in counts.items()}
    return out.withColumns(guarded).drop("_w", "_syl")


def sentence_rows(df: DataFrame, text: str = "text", repair: bool = True) -> DataFrame:
    """One row per sentence with its position and its blank-separated word count."""
    prose = T.strip(T.repair_spacing(text)) if repair else F.col(text)
    others = [c for c in df.columns if c != text]
    rows = unnest(df, others, T.sentences(prose), "sentence", "pos")
    words = F.filter(F.split("sentence", r"(?U)\s+"), lambda w: F.length(w) > 0)
    return rows.withColumn("n_words", F.size(words))


def sentence_stats(df: DataFrame, text: str = "text", repair: bool = True) -> DataFrame:
    """Sentence rows with the twelve mark counts."""
    rows = sentence_rows(df, text, repair)
    return rows.withColumns(
        {name: T.occurrences("sentence", mark) for mark, name in fixed.SENTENCE_MARKS.items()}
    )
