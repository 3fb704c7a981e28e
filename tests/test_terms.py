import math
from collections import Counter

from pyspark.sql import functions as F

from penprint.functions import fixed
from penprint.operators import bayes, scale, terms, topics

TEXTS = ["кот и пёс кот", "пёс бежит домой и кот", "а и б", "", "домой домой домой"]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc int, text string")


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    rows = [r["g"] for r in df.select(terms.ngrams_of(F.col("t"), 1, 3).alias("g")).collect()]
    assert rows == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def counts(spark, **options):
    return terms.term_counts(docs(spark), "doc", terms.vector_tokens("text"), **options)


def test_counts_and_vocabulary(spark):
    got = {(r["doc"], r["term"]): r["tf"] for r in counts(spark).collect()}
    assert got[(0, "кот")] == 2 and got[(4, "домой")] == 3 and (2, "а") not in got
    listed = terms.vocabulary(counts(spark), 5, min_df=2, max_df=0.5)
    assert {r["term"] for r in listed.collect()} == {"кот", "пёс", "домой"}
    top = terms.vocabulary(counts(spark), 5, max_features=2)
    assert {r["term"] for r in top.collect()} == {"домой", "кот"}


def test_tfidf(spark):
    table = counts(spark)
    rows = terms.tfidf(table, terms.vocabulary(table, 5), "doc", 5).collect()
    got = {(r["doc"], r["term"]): r["weight"] for r in rows}
    weight = {t: (tf, math.log(6 / (1 + df)) + 1) for t, tf, df in [("кот", 2, 2), ("пёс", 1, 2)]}
    length = math.sqrt(sum((tf * idf) ** 2 for tf, idf in weight.values()))
    for t, (tf, idf) in weight.items():
        assert math.isclose(got[(0, t)], tf * idf / length)


def test_char_ngrams(spark):
    df = spark.createDataFrame([(0, " Ааб x1 баба ")], "doc int, text string")
    rows = terms.char_ngrams(df, "doc", 2, fixed.RUSSIAN_LETTERS).collect()
    assert {(r["pos"], r["gram"]): r["n"] for r in rows} == {(0, "аа"): 1, (0, "аб"): 1, (2, "ба"): 2, (2, "аб"): 1}
    first = terms.char_ngrams(df, "doc", 1, max_tokens=1).collect()
    assert {(r["pos"], r["gram"]): r["n"] for r in first} == {(0, "а"): 2, (0, "б"): 1}
    words = spark.createDataFrame([("баба",)], "word string")
    assert [tuple(r) for r in terms.known_words(df, "doc", words).select("pos", "token").collect()] == [(2, "баба")]


def test_grammar_tokens(spark):
    df = spark.createDataFrame([("S,муж=(вин,ед|им,ед) ADV= PNT",)], "codes string")
    assert df.select(terms.grammar_tokens("codes").alias("t")).first()["t"] == ["S,муж", "вин,ед|им,ед", "ADV", "PNT"]


def test_top(spark):
    top = terms.top_ngrams(docs(spark), 2, 2).collect()
    counted = Counter()
    for text in TEXTS:
        words = [w for w in text.split() if len(w) > 1]
        counted.update(" ".join(p) for p in zip(words, words[1:]))
    best = sorted(counted.items(), key=lambda kv: (kv[1], kv[0]), reverse=True)[:2]
    assert [(r["term"], r["n"]) for r in top] == best


def test_naive_bayes(spark):
    labels = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "b")], "doc int, lab string")
    table = counts(spark).join(labels, "doc")
    model = bayes.fit(table, labels, "doc", "lab", alpha=0.5)
    rows = {(r["doc"], r["label"]): r["score"] for r in bayes.scores(model, table, labels, "doc").collect()}
    words = {"a": Counter(), "b": Counter()}
    for (doc, lab), text in zip([(0, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "b")], TEXTS):
        words[lab].update(w for w in text.split() if len(w) > 1)
    vocabulary = set(words["a"]) | set(words["b"])
    for doc, text in enumerate(TEXTS):
        for lab, prior in (("a", 2 / 5), ("b", 3 / 5)):
            total = sum(words[lab].values()) + 0.5 * len(vocabulary)
            want = math.log(prior) + sum(math.log((words[lab][w] + 0.5) / total) for w in text.split() if len(w) > 1)
            assert math.isclose(rows[(doc, lab)], want, rel_tol=1e-9)
    best = {r["doc"]: r["prediction"] for r in bayes.predict(model, table, labels, "doc").collect()}
    assert best[0] == "a" and best[4] == "b" and best[3] == "b"


def test_dictionary_limits(spark):
    rows = spark.createDataFrame(
        [(d, w) for d in range(10) for w in ["all"] + (["half"] if d < 5 else []) + (["two"] if d < 2 else [])], "doc int, lemma string"
    )
    table = topics.lemma_counts(rows, "doc")
    assert [r["term"] for r in topics.build_dictionary(table, 10, 3, 0.5, 10).collect()] == ["half"]
    assert topics.build_dictionary(table, 10, 1, 1.0, 2).count() == 2


def test_char_ngrams_of_repeated_documents_without_a_row_per_ngram_in_a_group(spark):
    """Texts of one id count together, place by place; only whole texts are grouped."""
    rows = [(1, "abab ab"), (1, "ab x abc"), (None, "bb"), (2, None), (2, " ")]
    df = spark.createDataFrame(rows, "doc int, text string")
    out = terms.char_ngrams(df, "doc", 2, "abc")
    got = {(r["doc"], r["pos"], r["gram"]): r["n"] for r in out.collect()}
    assert got == {(1, 0, "ab"): 3, (1, 0, "ba"): 1, (1, 1, "ab"): 1, (1, 2, "ab"): 1, (1, 2, "bc"): 1, (None, 0, "bb"): 1}
    grouped = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line]
    assert len(grouped) == 1 and "gram" not in grouped[0].split("]")[0]


def test_corpus_ngrams_count_documents_of_several_rows_once_and_shuffle_no_texts(spark):
    rows = [(1, "a b a"), (1, "b a"), (2, "a"), (None, "c c"), (None, "c d"), (3, None), (4, ""), (5, "b a b a")]
    df = spark.createDataFrame(rows, "doc bigint, text string").repartition(3)
    tokens = F.split("text", " ")
    for part in (df, df.where("doc > 1")):
        want = terms.document_frequency(terms.term_counts(part, "doc", tokens, 1, 3))
        got = terms.corpus_ngrams(part, "doc", tokens, 1, 3)
        assert got.columns == ["term", "df", "total"] and got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = terms.corpus_ngrams(df.where("doc > 1"), "doc", tokens, 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc" not in plan


def test_a_vocabulary_too_large_to_broadcast_is_not_copied(spark, monkeypatch):
    rows = [(i if i else None, [f"w{i % 7}", "a", "a", f"r{i}"] + (["b"] if i % 2 else [])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc int, t array<string>")
    counts = terms.term_counts(df, "doc", F.col("t"))
    listed = terms.vocabulary(counts, 40, min_df=1).where("term <> 'w3'")
    want = sorted(map(str, terms.tfidf(counts, listed, "doc", 40).withColumn("weight", F.round("weight", 9)).collect()))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(scale, "FREQUENT_ROWS", 5)
    out = terms.tfidf(counts, listed, "doc", 40).withColumn("weight", F.round("weight", 9))
    assert sorted(map(str, out.collect())) == want and len(want) > 100
    assert "_salt" not in out._jdf.queryExecution().executedPlan().toString()
