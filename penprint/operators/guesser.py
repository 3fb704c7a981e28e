"""Readings of word forms that no lexicon lists, guessed from their endings.

A rule says what forms with an ending are read as: tag, grammar, and how the lemma comes out of the form (letters to cut
and to add). Rules are counted over a lexicon for endings of several lengths; an unknown form takes the rule of its
longest ending that enough forms have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.scale import balanced, lookup_join, settled, unnest

LONGEST = 5  # letters of an ending
SUPPORT = 2  # forms that an ending needs


def common_prefix(a: Column, b: Column) -> Column:
    """Number of characters that two strings begin with in common."""
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(a), F.length(b))))

    def step(length: Column, i: Column) -> Column:
        same = (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))) & (F.length(a) >= i) & (F.length(b) >= i)
        return F.when((length == i - 1) & same, i).otherwise(length)

    return F.aggregate(places, F.lit(0), step)


def endings(form: Column, longest: int) -> Column:
    """The endings of 1 to ``longest`` letters that are shorter than the form."""
    sizes = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(longest), F.length(form) - 1)))
    return F.transform(F.filter(sizes, lambda n: n < F.length(form)), lambda n: F.right(form, n))


def ending_counts(lexicon: DataFrame, longest: int = LONGEST, weight: str | None = None) -> DataFrame:
    """How many forms of a lexicon follow each rule: ending, tag, gr, cut, add, n.

    A form counts for every ending that holds all letters its lemma changes. ``weight`` names a column of occurrences to
    count instead of forms. Null forms and lemmas are left out, null tags are read as tags of their own.
    """
    known = lexicon.where(F.col("form").isNotNull() & F.col("lemma").isNotNull())
    kept = common_prefix(F.col("form"), F.col("lemma"))
    rows = known.select(
        "tag", "gr", (F.length("form") - kept).alias("cut"), F.substring(F.col("lemma"), kept + 1, F.length("lemma")).alias("add"),
        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_n"), F.explode(endings(F.col("form"), longest)).alias("ending"),
    )
    fitting = rows.where(F.col("cut") <= F.length("ending"))
    return fitting.groupBy("ending", "tag", "gr", "cut", "add").agg(F.sum("_n").alias("n"))


def ending_rules(counts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """The most frequent rule of every ending with ``support`` forms or more: ending, tag, gr, cut, add, n, total.

    Of equally frequent rules the first in order of tag, gr, cut, add holds.
    """
    best = F.min(F.struct((-F.col("n")).alias("minus"), "tag", "gr", "cut", "add")).alias("b")
    rules = counts.groupBy("ending").agg(best, F.sum("n").alias("total")).where(F.col("total") >= support)
    return rules.select("ending", "b.tag", "b.gr", "b.cut", "b.add", (-F.col("b.minus")).alias("n"), "total")


def guess(forms: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Readings of forms from their endings: form, lemma, tag, gr, ending, n, total.

    Forms are taken once each; those none of whose endings has a rule are left out. n of total says how sure a guess is.
    """
    wanted = forms.select("form").where(F.col("form").isNotNull()).distinct()
    tried = wanted.select("form", F.explode(endings(F.col("form"), longest)).alias("ending"))
    matched = lookup_join(tried, rules, ["ending"], salt_on=["form"])
    columns = ["ending", "tag", "gr", "cut", "add", "n", "total"]
    found = matched.groupBy("form").agg(F.max_by(F.struct(*columns), F.length("ending")).alias("r")).select("form", "r.*")
    lemma = F.concat(F.substring(F.col("form"), F.lit(1), F.length("form") - F.col("cut")), F.col("add"))
    return found.select("form", lemma.alias("lemma"), "tag", "gr", "ending", "n", "total")


def completed(lexicon: DataFrame, forms: DataFrame, longest: int = LONGEST, support: int = SUPPORT) -> DataFrame:
    """A lexicon with guessed readings for those ``forms`` that it does not list.

    All lexicon operators take the result in place of the lexicon, so their unknown words get lemmas, tags and grammar.
    """
    listed = lexicon.select("form", "lemma", "tag", "gr")
    rules = settled(ending_rules(ending_counts(lexicon, longest), support))
    missing = forms.select("form").distinct().join(listed.select("form").distinct(), "form", "left_anti")
    return settled(listed.unionByName(guess(missing, rules, longest).select(listed.columns)))


def corpus_forms(df: DataFrame, text: str = "text", pattern: str = fixed.ANY_WORD) -> DataFrame:
    """The distinct lower-case word forms of a corpus."""
    return unnest(balanced(df), [], T.word_tokens(text, pattern), "form").distinct()


def accuracy(guesses: DataFrame, truth: DataFrame) -> DataFrame:
    """Right guesses by length of the ending: letters, forms, right_lemma, right_tag, right_gr."""
    known = truth.select("form", *[F.col(c).alias(f"_{c}") for c in ("lemma", "tag", "gr")])
    same = [F.count_if(F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(f"right_{c}") for c in ("lemma", "tag", "gr")]
    return guesses.join(known, "form").groupBy(F.length("ending").alias("letters")).agg(F.count("*").alias("forms"), *same)
