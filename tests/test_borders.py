import math
import random

import pytest
from pyspark.sql import functions as F

from penprint.operators import borders

WORDS = "house dog home old day went lived nobody rained slept spoke far we it was the all to us days yes time".split()


def corpus():
    """Random sentences in which every word stands inside and at the end, with two abbreviations before names."""
    rng = random.Random(1)
    out = []
    for k in range(120):
        parts = []
        for _ in range(8):
            words = rng.choices(WORDS, k=rng.randrange(4, 9))
            if rng.random() < 0.2:
                words[rng.randrange(1, len(words))] = rng.choice(["prof. Meyer", "dr. Weber", "prof. Lang"])
            parts.append(" ".join(words).capitalize().replace("meyer", "Meyer").replace("weber", "Weber").replace("lang", "Lang") + rng.choice("...!?"))
        out.append(" ".join(parts))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return borders.train(spark.createDataFrame([(t,) for t in corpus()], "text string"))


def cut(spark, model, text):
    table = spark.createDataFrame([(1, text)], "id int, text string")
    return [r["sentence"] for r in borders.split_sentences(table, model, "id").orderBy("pos").collect()]


def test_abbreviations_are_found_and_words_at_ends_are_not(model):
    found = {r["type"] for r in model.abbreviations.collect()}
    assert {"prof", "dr"} <= found and not found & set(WORDS)


@pytest.mark.parametrize(
    "text, want",
    [
        ("We met prof. Meyer at noon. The dog slept.", ["We met prof. Meyer at noon.", "The dog slept."]),
        ("It was dr. Weber! Was it far? Yes.", ["It was dr. Weber!", "Was it far?", "Yes."]),
        ("He said «no.» The dog slept.", ["He said «no.»", "The dog slept."]),
        ("It took 5. days to go. We went home.", ["It took 5. days to go.", "We went home."]),
        ("One  line.\nNext\tline.Last line", ["One line.", "Next line.", "Last line"]),
        ("This is J. Smith. We went home.", ["This is J. Smith.", "We went home."]),
        ("", []), (None, []), (" . ", ["."]), ("no marks", ["no marks"]),
    ],
)
def test_borders(spark, model, text, want):
    assert cut(spark, model, text) == want


def test_no_word_is_lost(spark, model):
    table = spark.createDataFrame(list(enumerate(corpus()[:30])), "id int, text string")
    rows = borders.split_sentences(table, model, "id").groupBy("id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))), lambda x: x["sentence"]), " ").alias("t"))
    assert {r["id"]: r["t"] for r in rows.collect()} == dict(enumerate(corpus()[:30]))


def test_scores_equal_the_formulas(spark):
    cases = [(a, b, both, n) for n in (50, 1000) for a in (5, 20) for b in (3, 30) for both in (0, 1, 3) if both <= min(a, b) and b - both <= n - a]

    def want(a, b, both, n):
        def part(k, m, p):
            return (k * math.log(p) if k else 0) + ((m - k) * math.log(1 - p) if m > k else 0)

        rest = b - both
        return -2 * (part(both, a, b / n) + part(rest, n - a, b / n) - part(both, a, both / a) - part(rest, n - a, rest / (n - a)))

    rows = spark.createDataFrame(cases, "a int, b int, both int, n int")
    rows = rows.select("*", borders.likelihood_ratio(F.col("a"), F.col("b"), F.col("both"), F.col("n")).alias("s")).collect()
    assert all(abs(r["s"] - want(*tuple(r)[:4])) < 1e-6 for r in rows)
    table = spark.createDataFrame([("e.g", 4, 1, 10, 500)], "t string, w int, o int, d int, n int")
    got = table.select(borders.abbreviation_score(*[F.col(c) for c in ("w", "o", "t", "d", "n")]).alias("s")).first()["s"]
    null, other = 4 * math.log(0.02) + math.log(0.98), 4 * math.log(0.99) + math.log(0.01)
    assert abs(got - -2 * (null - other) * math.exp(-2) * 2 * 2**-1) < 1e-9


def test_empty_corpus_cuts_at_every_mark(spark):
    none = borders.train(spark.createDataFrame([], "text string"))
    assert none.abbreviations.count() == none.collocations.count() == none.starters.count() == 0
    assert cut(spark, none, "We met prof. Meyer. Yes.") == ["We met prof.", "Meyer.", "Yes."]
