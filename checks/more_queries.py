"""Sources, sinks and the operators that the other queries do not run; write-and-read-back makes their SQL exact."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer, RegexTokenizer
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.model_queries import _mark_features
from checks.oracles import ORACLES, SENTENCES, USERS, PROBS, REPORT, q, strip, tokens_of
from checks.workload import LETTERS, _events, docs, probabilities, query, r6
from penprint.functions import fixed, text as T
from penprint.operators import evaluate, grouped, inference, lexicon, pos, profiles, scale, splits, stats, terms, usage
from penprint.session import run_folder
from penprint.sources import books
from penprint.sources.tables import read_table

SMALL_LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáéèêëíîïóôöúùûüœæçñß"


# sources and sinks


@query
def books_read(spark, folder):
    """Every document as a text file of its own below a folder per language, read back as books."""
    path = run_folder(spark, "books")
    rows = docs(spark, folder).select("text", "lang", F.concat(F.lit("b"), F.col("doc_id")).alias("book"))
    books.write_books(rows, path, "lang", value="text")
    read = books.read_books(spark, path)
    number = F.regexp_extract("book", r"book=b([0-9]+)\.txt", 1).cast("bigint")
    lang = F.regexp_extract("book", "^lang=([a-z]+)/", 1)
    return read.select(number.alias("doc_id"), lang.alias("lang"), F.regexp_replace("value", r"\n\z", "").alias("text"))


@query
def corpus_round_trip(spark, folder):
    path = run_folder(spark, "corpus")
    rows = docs(spark, folder).select(F.col("source").alias("target"), "text", F.col("doc_id").cast("string").alias("book"))
    books.write_corpus(rows, path)
    return books.read_corpus(spark, path)


@query
def catalogue_round_trip(spark, folder):
    path = run_folder(spark, "catalogue")
    table = docs(spark, folder).select(
        F.concat_ws(" ", "lang", "doc_id").alias("title"), F.col("source").alias("author"),
        F.regexp_extract("source", "([0-9]+)$", 1).cast("int").alias("author_id"), F.lit('a,"b".txt').alias("file_name"), F.lit("x\ny").alias("text_url"),
    )
    books.write_corpus(table, path)
    return books.read_catalogue(spark, path)


@query
def partitioned_corpus(spark, folder):
    """Parquet by language; the rows of one language come back by a partition filter."""
    path = run_folder(spark, "parts")
    books.write_corpus(docs(spark, folder).select("doc_id", "text", "lang"), path, "parquet", by="lang")
    return spark.read.parquet(path).where("lang = 'de'").select("doc_id", "lang", F.length("text").alias("n"))


@query
def stored_sentence_stats(spark, folder):
    path = run_folder(spark, "sentences")
    rows = docs(spark, folder).select(F.col("source").alias("author_id"), "doc_id", "text")
    books.write_sentence_stats(stats.sentence_stats(scale.balanced(rows)), path)
    read = books.read_sentence_stats(spark, path)
    counted = read.groupBy("author_id").agg(F.count("*").alias("n_sents"), F.sum("n_words").alias("n_words"))
    first = counted.agg(F.min("author_id")).first()[0]
    one = books.read_sentence_stats(spark, path, first).count()
    return counted.select(F.col("author_id").cast("string").alias("source"), "n_sents", "n_words", F.when(F.col("author_id") == first, one).alias("by_author"))


@query
def file_names(spark, folder):
    """File names of Cyrillic authors and titles made from the table's own values."""
    latin, cyrillic = "etaoinshrdlu0123456789", "етаоиншрдлужщюяёьъыэхц"
    rows = docs(spark, folder).select("doc_id", F.translate("source", latin, cyrillic).alias("author"), F.translate("lang", latin, cyrillic).alias("title"))
    return rows.select("doc_id", T.make_file_name("author", F.concat_ws("  ", "title", "doc_id")).alias("file_name"))


@query
def stored_model(spark, folder):
    """A fitted pipeline, saved and loaded: every document gets the same answer from both."""
    table = _mark_features(spark, folder).join(docs(spark, folder).select("doc_id", "text"), "doc_id")
    model, path = _word_model(table), run_folder(spark, "model")
    books.save_model(model, path)
    one, two = (m.transform(table).select("doc_id", "probability", "prediction") for m in (model, books.load_model(path)))
    both = one.join(two.select("doc_id", F.col("probability").alias("p"), F.col("prediction").alias("c")), "doc_id")
    return both.select("doc_id", ((F.col("probability") == F.col("p")) & (F.col("prediction") == F.col("c"))).alias("same"))


def _word_model(table: DataFrame):
    steps = [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+"), CountVectorizer(inputCol="words", outputCol="counts"),
        NaiveBayes(featuresCol="counts", labelCol="label"),
    ]
    return Pipeline(stages=steps).fit(table)


@query
def scored_csv(spark, folder):
    """A CSV of texts scored by a model and written as CSV: every row and column comes back, with an author's name."""
    table = _mark_features(spark, folder).join(docs(spark, folder).select("doc_id", "text"), "doc_id")
    source, target = run_folder(spark, "in"), run_folder(spark, "out")
    books.write_corpus(table.select("doc_id", "text", "lang"), source)
    books.score_csv(spark, source, target, _word_model(table), threshold=False)
    read = spark.read.csv(target, header=True, multiLine=True, quote='"', escape='"', schema="doc_id bigint, text string, lang string, author string")
    return read.select("doc_id", "text", "lang", F.col("author").isin(list(fixed.AUTHOR_NAMES.values())).alias("named"))


# selections


@query
def listed_rows(spark, folder):
    good = read_table(spark, folder, "labels").where("quality = 1")
    return splits.rows_in(docs(spark, folder), good, "doc_id").select("doc_id", "source")


@query
def sampled_rows(spark, folder):
    return splits.sample_n(docs(spark, folder), "doc_id", 100).select("doc_id", "lang")


@query
def spread_folds(spark, folder):
    """Grouped folds by least spread: the class shares of the folds are about as alike as by dealing in turn, or more."""
    table = docs(spark, folder).select("lang", F.floor(F.col("doc_id") / 3).cast("bigint").alias("book"))

    def gap(folds: DataFrame) -> float:
        cells = table.join(folds.select("book", "fold"), "book").groupBy("lang").pivot("fold", list(range(5))).count().na.fill(0)
        shares = [F.col(str(i)) / sum(F.col(str(j)) for j in range(5)) for i in range(5)]
        return cells.agg(F.avg(F.aggregate(F.array(*shares), F.lit(0.0), lambda a, x: a + (x - 0.2) * (x - 0.2)))).first()[0]

    folds = scale.settled(grouped.spread_group_folds(table, "lang", "book"))
    alike = gap(folds) <= gap(splits.stratified_group_folds(table, "lang", "book")) + 1e-3
    return folds.select("book", "n", F.col("fold").between(0, 4).alias("known"), F.lit(bool(alike)).alias("alike"))


@query
def first_user(spark, folder):
    states = usage.user_states(_events(spark, folder))
    return usage.get_user(states, states.agg(F.min("id")).first()[0])


@query
def run_records(spark, folder):
    """Two training runs logged with the scores of the table, read back."""
    scores = evaluate.f1_scores(probabilities(spark, folder).select("label", "prediction")).first().asDict()
    path = run_folder(spark, "runs")
    for number in (1, 2):
        record = evaluate.run_record(spark, f"model {number}", {"k": 5}, {"step__model__C": 0.5, "text__lemmatize": True}, scores, scores)
        evaluate.append_run(record, path)
    read = spark.read.parquet(path)
    test = F.col("test")
    return read.select("model", F.col("settings")["k"].alias("k"), F.col("params")["model"]["C"].alias("c"), r6(test["f1_micro"]).alias("f1_micro"), r6(test["f1_macro"]).alias("f1_macro"))


# whole results of operators whose first queries return a part


@query
def pos_profile_all(spark, folder):
    """All tags of the profile."""
    table = docs(spark, folder)
    out = pos.pos_profile(table, lexicon.synthetic_lexicon(table), "source", fixed.PROFILE_TAGS, alphabet=LETTERS)
    return out.select("source", "n_words", "tag", "n_sents", r6("mean_count").alias("mean_count"))


@query
def char_unigrams(spark, folder):
    """Letters of every token, by its place."""
    return terms.char_ngrams(docs(spark, folder), "doc_id", 1, alphabet=SMALL_LETTERS).select("doc_id", "pos", "gram", "n")


@query
def char_bigram_rows(spark, folder):
    """Pairs of letters of every token, by its place."""
    return terms.char_ngrams(docs(spark, folder), "doc_id", 2, alphabet=SMALL_LETTERS).select("doc_id", "pos", "gram", "n")


@query
def punct_profile_lengths(spark, folder):
    """The lengths that a report shows."""
    out = profiles.at_lengths(profiles.punct_profile(scale.balanced(docs(spark, folder)), "source"))
    return out.select("source", "n_words", "n_sents", *[r6(c).alias(c) for c in fixed.SENTENCE_MARKS.values()])


@query
def confusion_table(spark, folder):
    out = profiles.confusion_wide(probabilities(spark, folder), "label", "prediction", [0, 1, 2, 3])
    return out.select("label", *[F.col(str(k)).alias(f"p{k}") for k in range(4)])


@query
def best_and_rest(spark, folder):
    ranked = inference.rank_authors(probabilities(spark, folder), "doc_id")
    out = inference.best_and_rest(ranked, "doc_id")
    return out.select("doc_id", "label", r6("p").alias("p"), r6("rest").alias("rest"))


ORACLES["books_read"] = "SELECT doc_id, lang, text FROM documents"
ORACLES["corpus_round_trip"] = "SELECT source AS target, text, CAST(doc_id AS VARCHAR) AS book FROM documents"
ORACLES["catalogue_round_trip"] = """
SELECT lang || ' ' || doc_id AS title, source AS author, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS author_id,
       'a,"b".txt' AS file_name, 'x' || chr(10) || 'y' AS text_url FROM documents"""
ORACLES["partitioned_corpus"] = "SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n FROM documents WHERE lang = 'de'"
ORACLES["stored_sentence_stats"] = f"""
WITH {SENTENCES}, c AS (SELECT source, count(*)::BIGINT AS n_sents, sum(n_words)::BIGINT AS n_words FROM counted GROUP BY source)
SELECT source, n_sents, n_words, CASE WHEN source = (SELECT min(source) FROM c) THEN n_sents END::INTEGER AS by_author FROM c"""


def _latin(sql: str) -> str:
    source, target = fixed.TRANSLIT_SINGLE
    out = f"translate(lower({sql}), {q(source)}, {q(target)})"
    for letter, latin in fixed.TRANSLIT_MULTI.items():
        out = f"replace({out}, {q(letter)}, {q(latin)})"
    return out


_CYRILLIC = "translate({}, 'etaoinshrdlu0123456789', 'етаоиншрдлужщюяёьъыэхц')".format
_name = f"{_CYRILLIC('source')} || ' ' || {_CYRILLIC('lang')} || '  ' || doc_id"
ORACLES["file_names"] = rf"SELECT doc_id, regexp_replace({strip(_latin(_name))}, '\s+', '_', 'g') AS file_name FROM documents"
ORACLES["stored_model"] = "SELECT doc_id, true AS same FROM documents"
ORACLES["scored_csv"] = "SELECT doc_id, text, lang, true AS named FROM documents"
ORACLES["listed_rows"] = "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"
ORACLES["sampled_rows"] = "SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42') LIMIT 100"
ORACLES["first_user"] = f"""
WITH {USERS} SELECT user_id AS id, requests, rating FROM requests JOIN ratings USING (user_id) WHERE user_id = (SELECT min(user_id) FROM signups)"""
ORACLES["spread_folds"] = "SELECT doc_id // 3 AS book, count(*)::BIGINT AS n, true AS known, true AS alike FROM documents GROUP BY 1"
ORACLES["run_records"] = f"""
WITH {REPORT}, f AS (SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS f1_micro, round(avg(f1), 6) AS f1_macro FROM report)
SELECT 'model ' || n AS model, '5' AS k, '0.5' AS c, f1_micro, f1_macro FROM f, (SELECT unnest([1, 2]) AS n)"""
_tags = ", ".join(q(t) for t in fixed.PROFILE_TAGS)
ORACLES["pos_profile_all"] = ORACLES["pos_profile"].replace("unnest(['V', 'S', 'A', 'ADV', 'PR', 'CONJ'])", f"unnest([{_tags}])")
for _key, _n in (("char_unigrams", 1), ("char_bigram_rows", 2)):
    ORACLES[_key] = f"""
WITH toks AS ({tokens_of("documents", f"string_split(lower({strip('text')}), ' ')")}),
grams AS (SELECT doc_id, pos, substring(token, i, {_n}) AS gram FROM (SELECT doc_id, pos, token, unnest(range(1, length(token) + {2 - _n})) AS i FROM toks))
SELECT doc_id, pos, gram, count(*)::BIGINT AS n FROM grams WHERE regexp_matches(gram, '^[a-zàâäáéèêëíîïóôöúùûüœæçñß]{{{_n}}}$') GROUP BY ALL"""
_lengths = ", ".join(map(str, fixed.PROFILE_LENGTHS))
ORACLES["punct_profile_lengths"] = f"SELECT * FROM ({ORACLES['punct_profile']}) WHERE n_words IN ({_lengths})"
ORACLES["confusion_table"] = f"""
WITH {PROBS} SELECT label, {", ".join(f"count(*) FILTER (WHERE prediction = {k})::BIGINT AS p{k}" for k in range(4))} FROM predicted GROUP BY label"""
ORACLES["best_and_rest"] = f"""
WITH {PROBS}, r AS (SELECT doc_id, CAST(unnest(range(4)) AS INTEGER) AS label, unnest(probability) AS p FROM predicted),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, label) AS rank FROM r)
SELECT doc_id, min(label) FILTER (WHERE rank = 1) AS label, round(max(p) FILTER (WHERE rank = 1), 6) AS p,
       round(coalesce(sum(p) FILTER (WHERE rank > 1), 0), 6) AS rest FROM k GROUP BY doc_id"""
