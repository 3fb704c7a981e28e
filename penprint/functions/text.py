"""Text scalars: Column in, Column out, all built from Spark functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from penprint.functions import fixed

_WORD_CHAR = r"\p{L}\p{M}\p{N}_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(fixed.WHITESPACE))


def to_lower(c: Column | str) -> Column:
    return F.lower(_col(c))


def remove_numbers(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\p{Nd}+", "")


def remove_http(c: Column | str) -> Column:
    """Only short t.co links count as links."""
    return strip(F.regexp_replace(_col(c), r"(?U)\s*https?://t.co/[A-Za-zа-яА-Я0-9]*\s*", " "))


def remove_short_words(c: Column | str) -> Column:
    blanked = F.regexp_replace(_col(c), r"(?U)\b\w{1,2}\b", " ")
    return strip(F.regexp_replace(blanked, r"(?U)\s{2,}", " "))


def remove_punctuation(c: Column | str) -> Column:
    blanked = F.translate(_col(c), fixed.BLANKED_MARKS, " " * len(fixed.BLANKED_MARKS))
    return strip(F.regexp_replace(blanked, r"(?U)\s+", " "))


def clean_sentence(c: Column | str, alphabet: str = "а-яА-ЯёЁ") -> Column:
    """Keep the alphabet and a few marks; everything else is deleted."""
    return F.regexp_replace(_col(c), f"[^{alphabet}{fixed.KEPT_MARKS}]", "")


def encode_punct(c: Column | str, scheme: str = "core") -> Column:
    """Marks become code words; a hyphen inside a word stays."""
    out = _col(c)
    for mark, code in fixed.MARK_CODES[scheme]:
        out = F.replace(out, F.lit(mark), F.lit(f" {code} "))
    return F.regexp_replace(out, r"(?U)\s?-\s|\s-\s?", f" {fixed.FREE_DASH_CODE[scheme]} ")


def repair_spacing(c: Column | str) -> Column:
    squeezed = F.regexp_replace(_col(c), r"(?U)\s+", " ")
    return F.regexp_replace(squeezed, rf"([{_WORD_CHAR}])([.:])([{_WORD_CHAR}])", "$1$2 $3")


def strip_for_morph(c: Column | str, alphabet: str = "а-яА-ЯёЁ") -> Column:
    letters = F.regexp_replace(_col(c), rf"[^{alphabet} \-]", "")
    return F.regexp_replace(letters, r"\s?-\s|\s-\s?", " ")


def plain_prose(c: Column | str) -> Column:
    """Lower-case text without links, digits, punctuation and line breaks."""
    text = F.regexp_replace(F.lower(_col(c)), r"(?U)https?://\S+", " ")
    text = F.regexp_replace(text, r"\p{Nd}+", "")
    return strip(F.regexp_replace(text, r"(?U)[\p{P}\p{S}\s]+", " "))


def extract_all(c: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0))


def word_tokens(c: Column | str, pattern: str = fixed.CYRILLIC_WORD) -> Column:
    return extract_all(F.lower(_col(c)), pattern)


def punct_tokens(c: Column | str) -> Column:
    return extract_all(c, fixed.MARK_PATTERN)


def treebank_tokens(c: Column | str) -> Column:
    """Words with inner hyphens, the ellipsis, and single marks."""
    return extract_all(
        c, rf"[{_WORD_CHAR}]+(?:-[{_WORD_CHAR}]+)*|\.{{3}}|[^{_WORD_CHAR}\s]"
    )


def chunk_tokens(c: Column | str, letters: str = r"\p{L}") -> Column:
    """Words with inner hyphens, and the stretches between them."""
    return extract_all(c, rf"[{letters}]+(?:-[{letters}]+)*|[^{letters}]+")


def sentences(c: Column | str) -> Column:
    pieces = F.split(_col(c), r"(?<=[.!?])\s+")
    return F.filter(pieces, lambda s: F.length(s) > 0)


def remove_stopwords(tokens: Column | str, stop: Iterable[str]) -> Column:
    """For short lists; long ones go through ``lexicon.drop_listed``."""
    listed = list(stop)
    if not listed:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~t.isin(listed))


def russian_stopwords(spark: SparkSession, keep_negations: bool = False) -> list[str]:
    """Spark's own Russian list, optionally without the negations."""
    from pyspark.ml.feature import StopWordsRemover

    listed = StopWordsRemover.loadDefaultStopWords("russian")
    return [w for w in listed if not (keep_negations and w in fixed.KEPT_STOPWORDS)]


def is_wanted_token(
    token: Column, stop: Iterable[str] = (), min_length: int = 0, drop_marks: bool = True
) -> Column:
    """The token filter of the cleaning recipes.

    A stripped token that occurs inside the ASCII mark list counts as a mark, so
    blank tokens go as well.
    """
    keep = (token != " ") & ~token.rlike(r"^\p{Nd}+$")
    if min_length:
        keep = keep & (F.length(token) >= min_length)
    if drop_marks:
        keep = keep & ~F.contains(F.lit(fixed.ASCII_MARKS), strip(token))
    listed = list(stop)
    return keep & ~token.isin(listed) if listed else keep


def filter_tokens(tokens: Column | str, **rules) -> Column:
    return F.filter(_col(tokens), lambda t: is_wanted_token(t, **rules))


def short_tag(grammar: Column | str) -> Column:
    """Part of speech: the leading word of a grammar string."""
    return F.regexp_extract(_col(grammar), r"^[\p{L}\p{N}_]*", 0)


def brief_grammar(grammar: Column | str) -> Column:
    return F.substring_index(_col(grammar), "=", 1)


def occurrences(c: Column | str, piece: str) -> Column:
    """How often a fixed string occurs, without overlaps."""
    column = _col(c)
    gone = F.length(column) - F.length(F.replace(column, F.lit(piece), F.lit("")))
    return (gone / F.lit(len(piece))).cast("int")


def target_to_int(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"^{fixed.PREFIX_STEM}0?", "").cast("int")


def author_prefix(author_id: Column | str) -> Column:
    digits = _col(author_id).cast("string")
    padded = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    return F.concat(F.lit(fixed.PREFIX_STEM), padded)


def transliterate(c: Column | str) -> Column:
    source, target = fixed.TRANSLIT_SINGLE
    out = F.translate(F.lower(_col(c)), source, target)
    for letter, latin in fixed.TRANSLIT_MULTI.items():
        out = F.replace(out, F.lit(letter), F.lit(latin))
    return out


def make_file_name(author: Column | str, title: Column | str) -> Column:
    both = F.concat_ws(" ", _col(author), _col(title))
    return F.regexp_replace(strip(transliterate(both)), r"(?U)\s+", "_")


def label_name(label: Column | str) -> Column:
    pairs = [F.lit(x) for pair in fixed.AUTHOR_NAMES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _col(label).cast("int"))
