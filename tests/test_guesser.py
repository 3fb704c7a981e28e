import os

import pytest
from pyspark.sql import functions as F

from penprint.functions import text as T
from penprint.operators import guesser, lexicon

#: Regular inflection: ending of the form, ending of the lemma, tag, grammar.
NOUN = [("а", "а", "S", "S,жен=им,ед"), ("ы", "а", "S", "S,жен=им,мн"), ("у", "а", "S", "S,жен=вин,ед"), ("ами", "а", "S", "S,жен=твор,мн")]
VERB = [("ать", "ать", "V", "V=инф"), ("ает", "ать", "V", "V=непрош,ед"), ("али", "ать", "V", "V=прош,мн")]
STEMS = ["комнат", "картин", "машин", "газет", "собак", "рыб", "зим", "гор", "ламп", "звезд"]
ROOTS = ["чит", "игр", "дел", "дум", "раб", "слуш", "реш", "жел"]


def inflected(stems, paradigm):
    return [(s + form, s + lemma, tag, gr) for s in stems for form, lemma, tag, gr in paradigm]


@pytest.fixture(scope="module")
def words(spark):
    rows = inflected(STEMS, NOUN) + inflected(ROOTS, VERB) + [("я", "я", "S-PRO", "S-PRO=им"), (None, "x", "S", "S=")]
    return spark.createDataFrame(rows, "form string, lemma string, tag string, gr string")


@pytest.mark.parametrize("a, b", [("книги", "книга"), ("", "x"), ("same", "same"), ("ab", "abc"), ("лучше", "хороший"), ("a", "")])
def test_common_prefix(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(guesser.common_prefix(F.col("a"), F.col("b")).alias("n")).first()
    assert row["n"] == len(os.path.commonprefix([a, b]))


def test_endings_are_shorter_than_the_form(spark):
    rows = spark.createDataFrame([("abcd",), ("a",), ("",), ("ab",), ("abcdefgh",)], "f string")
    got = [r["e"] for r in rows.select(guesser.endings(F.col("f"), 3).alias("e")).collect()]
    assert got == [["d", "cd", "bcd"], [], [], ["b"], ["h", "gh", "fgh"]]


def test_new_words_of_a_known_paradigm_are_read_right(spark, words):
    rules = guesser.ending_rules(guesser.ending_counts(words))
    new = inflected(["страниц", "полян"], NOUN) + inflected(["кач", "ныр"], VERB)
    guessed = guesser.guess(spark.createDataFrame([(f[0],) for f in new] * 2 + [(None,), ("q",), ("zz",)], "form string"), rules)
    assert {(r["form"], r["lemma"], r["tag"], r["gr"]) for r in guessed.collect()} == set(new) and guessed.count() == len(new)
    report = guesser.accuracy(guessed, spark.createDataFrame(new, words.schema)).collect()
    assert sum(r["forms"] for r in report) == sum(r["right_gr"] for r in report) == len(new)


def test_counts_equal_plain_python(spark, words):
    want = {}
    for form, lemma, tag, gr in words.collect():
        if form is None:
            continue
        kept = len(os.path.commonprefix([form, lemma]))
        for n in range(1, min(5, len(form) - 1) + 1):
            if len(form) - kept <= n:
                key = (form[-n:], tag, gr, len(form) - kept, lemma[kept:])
                want[key] = want.get(key, 0) + 1
    assert {tuple(r)[:5]: r["n"] for r in guesser.ending_counts(words).collect()} == want


def test_ties_support_and_weights(spark):
    rows = [("xab", "xab", "V", "V=", 1), ("yab", "yab", "A", "A=", 1), ("zzc", "zzc", "S", "S=", 1), ("wwc", "wwc", "V", "V=", 5)]
    table = spark.createDataFrame(rows, "form string, lemma string, tag string, gr string, seen int")
    rules = {r["ending"]: r for r in guesser.ending_rules(guesser.ending_counts(table)).collect()}
    assert rules["ab"]["tag"] == "A" and rules["ab"]["total"] == 2 and "wc" not in rules
    weighted = {r["ending"]: r["tag"] for r in guesser.ending_rules(guesser.ending_counts(table, weight="seen"), 1).collect()}
    assert weighted["c"] == "V" and weighted["zc"] == "S"


def test_completed_lexicon_serves_the_other_operators(spark, words):
    docs = spark.createDataFrame([(1, "Полянами читает страницу"), (2, "")], "id int, text string")
    full = guesser.completed(words.where("form is not null"), guesser.corpus_forms(docs, pattern="[а-яё]+"))
    got = {r["id"]: r["lemmas"] for r in lexicon.lemmatize(docs, full, T.word_tokens("text", "[а-яё]+"), "id").collect()}
    assert got == {1: ["поляна", "читать", "страница"], 2: []}
    codes = lexicon.grammar_codes(docs, full, "id").where("id = 1").first()["codes"]
    assert codes == "S,жен=твор,мн V=непрош,ед S,жен=вин,ед"
    assert full.groupBy("form").count().where("count > 1").count() == 0


def test_empty_tables(spark, words):
    none = words.limit(0)
    assert guesser.ending_rules(guesser.ending_counts(none)).count() == 0
    assert guesser.completed(none, words.where("form is not null")).count() == 0
    assert guesser.guess(none, guesser.ending_rules(guesser.ending_counts(words))).count() == 0
