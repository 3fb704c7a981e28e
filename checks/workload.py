"""The registered queries: every operator over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators import (
    bayes, catalogue, chunking, evaluate, inference, lexicon, neighbours, pos, profiles, recipes,
    scale, splits, stats, terms, topics, usage, vectors,
)
from penprint.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WORD = fixed.ANY_WORD
LETTERS = r"\p{L}"
STOP = ["the", "and", "of", "to", "in", "der", "die", "und", "que", "de", "la", "le", "les", "et"]
KEYWORDS = {
    "de": ["der", "die", "und", "sch", "ich"],
    "en": ["the", "and", "of", "to", "that"],
    "es": ["que", "el", "los", "para", "con"],
    "fr": ["le", "les", "et", "des", "un"],
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def author_number() -> Column:
    return F.regexp_extract("source", r"([0-9]+)$", 1).cast("int")


# sources and catalogue


@query
def split_author_prefix(spark, folder):
    raw = docs(spark, folder).select("doc_id", F.concat(T.author_prefix(author_number()), "text").alias("value"))
    return chunking.split_author_prefix(raw).select("doc_id", "target", "text")


@query
def author_catalogue(spark, folder):
    books = docs(spark, folder).select(author_number().alias("author_id"), F.col("source").alias("author"))
    return catalogue.author_names(books)


@query
def extract_pages(spark, folder):
    pages = read_table(spark, folder, "pages")
    return catalogue.extract_page_text(pages, "p", None, nests=False).select("page_id", "text")


def _works(spark, folder):
    pages = read_table(spark, folder, "pages")
    texts = catalogue.extract_page_text(pages, "p", None, nests=False)
    return texts.select(
        catalogue.page_key("url").alias("work"), catalogue.page_number("url").alias("page"), "page_id", "text"
    )


@query
def assemble_works(spark, folder):
    return catalogue.assemble_works(_works(spark, folder), "work", "page", "page_id")


@query
def ordered_pages(spark, folder):
    return catalogue.ordered_pages(_works(spark, folder), "work", "page", "page_id")


@query
def plan_titles(spark, folder):
    tasks = read_table(spark, folder, "pages").select(catalogue.page_key("url").alias("title"))
    found = docs(spark, folder).select(F.concat_ws("/", "lang", "doc_id").alias("title"))
    return catalogue.plan_titles(tasks, found)


@query
def author_ids(spark, folder):
    ids = catalogue.assign_author_ids(docs(spark, folder), "source", "doc_id")
    return ids.select("source", "first_seen", "author_id", "prefix", T.target_to_int("prefix").alias("target"))


# text scalars


@query
def clean_text(spark, folder):
    return scale.balanced(docs(spark, folder)).select(
        "doc_id",
        T.to_lower("text").alias("lowered"),
        T.remove_numbers("text").alias("no_numbers"),
        T.remove_http("text").alias("no_links"),
        T.remove_punctuation("text").alias("no_marks"),
    )


@query
def clean_sentence(spark, folder):
    return scale.balanced(docs(spark, folder)).select(
        "doc_id",
        T.clean_sentence("text", LETTERS).alias("cleaned"),
        T.repair_spacing("text").alias("repaired"),
        T.strip_for_morph("text", LETTERS).alias("for_morph"),
    )


@query
def encode_punct(spark, folder):
    return scale.balanced(docs(spark, folder)).select("doc_id", T.encode_punct("text").alias("coded"))


@query
def encode_punct_verbose(spark, folder):
    return scale.balanced(docs(spark, folder)).select("doc_id", T.encode_punct("text", "verbose").alias("coded"))


@query
def remove_short_words(spark, folder):
    return scale.balanced(docs(spark, folder)).select("doc_id", T.remove_short_words("text").alias("long_words"))


@query
def word_tokens(spark, folder):
    tokens = scale.balanced(docs(spark, folder)).select("doc_id", T.word_tokens("text", WORD).alias("t"))
    return tokens.select(
        "doc_id",
        F.size("t").alias("n_tokens"),
        F.array_join("t", " ").alias("tokens"),
        F.array_join(T.remove_stopwords("t", STOP), " ").alias("kept"),
    )


@query
def punct_tokens(spark, folder):
    tokens = scale.balanced(docs(spark, folder)).select("doc_id", T.punct_tokens("text").alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n_marks"), F.array_join("t", " ").alias("marks"))


@query
def sentences(spark, folder):
    return scale.unnest(scale.balanced(docs(spark, folder)), ["doc_id"], T.sentences("text"), "sentence", "pos")


@query
def lemmatized_text(spark, folder):
    table = docs(spark, folder)
    words = lexicon.synthetic_lexicon(table)
    out = lexicon.lemmatize(table, words, T.word_tokens("text", WORD), "doc_id")
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@query
def preprocess_recipes(spark, folder):
    table = docs(spark, folder)
    return recipes.preprocess(table, lexicon.synthetic_lexicon(table), "doc_id", stop=STOP)


@query
def grammar_codes(spark, folder):
    table = docs(spark, folder)
    words = lexicon.synthetic_lexicon(table)
    return lexicon.grammar_codes(table, words, "doc_id", alphabet=LETTERS)


@query
def grammar_codes_brief(spark, folder):
    table = docs(spark, folder)
    words = lexicon.synthetic_lexicon(table)
    return lexicon.grammar_codes(table, words, "doc_id", full=False, alphabet=LETTERS)


@query
def label_names(spark, folder):
    rows = docs(spark, folder).withColumn("author_id", author_number() % 11 - 1)
    coded = catalogue.encode_labels(rows.select("doc_id", "lang", "author_id"), "lang")
    return catalogue.map_labels(coded, "author_id").select(
        "doc_id", F.col("lang").alias("language"), "label_id", "author_id", "name"
    )


# features


@query
def sent_stats(spark, folder):
    out = stats.sent_stats(scale.balanced(docs(spark, folder)))
    return out.select("doc_id", *fixed.TEXT_MARKS.values(), r6("avg_snt_len").alias("avg_snt_len"))


@query
def token_stats(spark, folder):
    out = stats.token_stats(scale.balanced(docs(spark, folder)), pattern=WORD)
    return out.select("doc_id", *[r6(c).alias(c) for c in stats.TOKEN_STATS])


@query
def pos_stats(spark, folder):
    table = docs(spark, folder)
    out = pos.pos_stats(table, lexicon.synthetic_lexicon(table), "doc_id", pattern=WORD)
    return out.select("doc_id", *[r6(c).alias(c) for c in pos.POS_STATS])


@query
def text_stats(spark, folder):
    table = docs(spark, folder)
    out = pos.text_stats(table, "doc_id", lexicon=lexicon.synthetic_lexicon(table), pattern=WORD)
    real = ["avg_snt_len", *stats.TOKEN_STATS, "punct2word", *pos.POS_STATS]
    return out.select("doc_id", *fixed.TEXT_MARKS.values(), *[r6(c).alias(c) for c in real])


@query
def text_profile(spark, folder):
    out = stats.text_profile(scale.balanced(docs(spark, folder)))
    return out.select(
        "doc_id", "n_chars_total", "word_count",
        r6("mean_word_length").alias("mean_word_length"), r6("mean_sent_length").alias("mean_sent_length"),
    )


@query
def basic_stats(spark, folder):
    out = stats.basic_stats(scale.balanced(docs(spark, folder)), vowels=fixed.LATIN_VOWELS)
    return out.select("doc_id", *stats.BASIC_STATS)


@query
def sentence_stats(spark, folder):
    out = stats.sentence_stats(scale.balanced(docs(spark, folder)))
    return out.select("doc_id", "pos", "n_words", *fixed.SENTENCE_MARKS.values())


@query
def pos_shares(spark, folder):
    table = docs(spark, folder)
    out = pos.pos_shares(table, lexicon.synthetic_lexicon(table), "doc_id", pattern=WORD)
    return out.select("doc_id", "tag", "n", r6("share").alias("share"))


@query
def pos_examples(spark, folder):
    table = docs(spark, folder)
    out = pos.pos_examples(table, lexicon.synthetic_lexicon(table), "doc_id", pattern=WORD)
    return out.select("tag", "rank", "token")


@query
def ngram_counts(spark, folder):
    return terms.corpus_ngrams(docs(spark, folder), "doc_id", terms.vector_tokens("text"), 1, 3)


def _counts(spark, folder, **options):
    return terms.term_counts(docs(spark, folder), "doc_id", terms.vector_tokens("text"), **options)


@query
def bow_filtered(spark, folder):
    n_docs = docs(spark, folder).count()
    counts = _counts(spark, folder)
    listed = terms.vocabulary(counts, n_docs, min_df=5, max_df=0.5)
    return terms.bag_of_words(counts, listed, "doc_id")


@query
def tfidf_terms(spark, folder):
    n_docs = docs(spark, folder).count()
    counts = _counts(spark, folder)
    out = terms.tfidf(counts, terms.vocabulary(counts, n_docs), "doc_id", n_docs)
    return out.select("doc_id", "term", r6("weight").alias("weight"))


@query
def grammar_bow(spark, folder):
    table = docs(spark, folder)
    coded = lexicon.grammar_codes(table, lexicon.synthetic_lexicon(table), "doc_id", alphabet=LETTERS)
    return terms.corpus_ngrams(scale.stored(coded, "codes"), "doc_id", terms.grammar_tokens("codes"), 1, 3)


@query
def char_bigrams(spark, folder):
    rows = terms.char_ngrams(docs(spark, folder), "doc_id", 2, alphabet="abcdefghijklmnopqrstuvwxyzàâäáéèêëíîïóôöúùûüœæçñß")
    return rows.groupBy("doc_id", "gram").agg(
        F.sum("n").alias("total"), F.count("*").alias("n_positions"), F.max("n").alias("most")
    )


@query
def clip_p99(spark, folder):
    counted = stats.text_profile(scale.balanced(docs(spark, folder)))
    columns = ["n_chars_total", "word_count", "mean_word_length"]
    out = vectors.clip_upper(counted.select("doc_id", *columns), columns, 0.99)
    return out.select("doc_id", *[r6(c).alias(c) for c in columns])


# profiles


@query
def class_distribution(spark, folder):
    out = profiles.class_distribution(docs(spark, folder), "lang")
    return out.select("lang", "n", r6("share").alias("share"))


def _basic(spark, folder):
    return stats.basic_stats(scale.balanced(docs(spark, folder)), vowels=fixed.LATIN_VOWELS)


@query
def profile_mean(spark, folder):
    out = profiles.profile_mean(_basic(spark, folder), "source")
    return out.select("source", *[r6(c).alias(c) for c in stats.BASIC_STATS])


@query
def profile_median(spark, folder):
    out = profiles.profile_median(_basic(spark, folder), "source")
    return out.select("source", *[r6(c).alias(c) for c in stats.BASIC_STATS])


@query
def pos_median_profile(spark, folder):
    table = docs(spark, folder)
    out = profiles.pos_median_profile(
        table, lexicon.synthetic_lexicon(table), "doc_id", "source", fixed.RATIO_TAGS, pattern=WORD
    )
    return out.select(
        "source", "tag", "tag_rank", r6("median_share").alias("median_share"),
        r6("global_median").alias("global_median"),
    )


@query
def sentence_length_dist(spark, folder):
    out = profiles.sentence_length_dist(scale.balanced(docs(spark, folder)), "source")
    return out.select("source", "place", "n_words", r6("freq").alias("freq"))


@query
def punct_profile(spark, folder):
    out = profiles.punct_profile(scale.balanced(docs(spark, folder)), "source")
    marks = fixed.SENTENCE_MARKS.values()
    return out.select("source", "n_words", "n_sents", *[r6(c).alias(c) for c in marks])


@query
def pos_profile(spark, folder):
    table = docs(spark, folder)
    tags = ["V", "S", "A", "ADV", "PR", "CONJ"]
    out = pos.pos_profile(table, lexicon.synthetic_lexicon(table), "source", tags, alphabet=LETTERS)
    return out.select("source", "n_words", "tag", "n_sents", r6("mean_count").alias("mean_count"))


@query
def top_words(spark, folder):
    table = docs(spark, folder)
    rows = recipes.recipe_lemmas(table, lexicon.synthetic_lexicon(table), "doc_id", 1, stop=STOP)
    return terms.most_frequent(rows, "lemma", 50)


@query
def top_bigrams(spark, folder):
    return terms.top_ngrams(docs(spark, folder), 2)


@query
def top_trigrams(spark, folder):
    return terms.top_ngrams(docs(spark, folder), 3)


@query
def docs_per_author(spark, folder):
    return profiles.books_per_author(docs(spark, folder), "source", "doc_id")


@query
def author_sentences(spark, folder):
    out = profiles.author_sentences(scale.balanced(docs(spark, folder)), "source", "doc_id")
    return out.select("source", "doc_id", "pos", "sentence", "n_words")


# splits


@query
def balance_classes(spark, folder):
    return splits.balance_classes(docs(spark, folder), "lang", "doc_id").select("doc_id", "lang", "text")


@query
def holdout(spark, folder):
    return splits.stratified_holdout(docs(spark, folder), "lang", "doc_id").select("doc_id", "lang", "split")


@query
def nested_holdout(spark, folder):
    return splits.nested_holdout(docs(spark, folder), "lang", "doc_id").select("doc_id", "lang", "split")


@query
def stratified_folds(spark, folder):
    return splits.stratified_folds(docs(spark, folder), "lang", "doc_id").select("doc_id", "lang", "fold")


def _sentence_keys(spark, folder):
    table = scale.balanced(docs(spark, folder)).select("doc_id", "lang", "text")
    return stats.sentence_rows(table).select("doc_id", "lang", "pos")


def _folds(spark, folder):
    return splits.stratified_group_folds(_sentence_keys(spark, folder), "lang", "doc_id")


@query
def group_folds(spark, folder):
    return _folds(spark, folder).select("doc_id", "lang", "n", "fold")


@query
def best_fold(spark, folder):
    out = splits.fold_rmse(_folds(spark, folder), "lang")
    return out.select("fold", r6("rmse").alias("rmse"))


@query
def apply_split(spark, folder):
    folds = scale.settled(_folds(spark, folder))
    best = splits.best_fold(folds, "lang")
    return splits.apply_split(_sentence_keys(spark, folder), folds, "doc_id", best).select("doc_id", "pos", "split")


@query
def leakage_check(spark, folder):
    folds = scale.settled(_folds(spark, folder))
    tagged = splits.apply_split(_sentence_keys(spark, folder), folds, "doc_id", splits.best_fold(folds, "lang"))
    train, test = tagged.where("split = 'train'"), tagged.where("split = 'test'")
    shared = splits.shared_groups(train, test, "doc_id").agg(F.count("*").alias("n_shared"))
    rows = splits.union_corpora(train, test).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test")
    )
    return rows.join(F.broadcast(shared), F.lit(True))


# topics


CONTENT = {"tags": ["S", "A", "V"], "stop": STOP}


@query
def content_lemmas(spark, folder):
    table = docs(spark, folder)
    out = topics.content_lemmas(table, lexicon.synthetic_lexicon(table), "doc_id", **CONTENT)
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


def _dictionary(spark, folder):
    table = docs(spark, folder)
    rows = topics.content_rows(table, lexicon.synthetic_lexicon(table), "doc_id", **CONTENT)
    counts, n_docs = topics.lemma_counts(rows, "doc_id"), table.count()
    return counts, topics.build_dictionary(counts, n_docs), n_docs


@query
def dictionary(spark, folder):
    return _dictionary(spark, folder)[1].select("term", "df")


@query
def doc2bow(spark, folder):
    counts, listed, n_docs = _dictionary(spark, folder)
    out = terms.tfidf_log2(counts, listed, "doc_id", n_docs)
    return out.select("doc_id", "term", "tf", r6("weight").alias("weight"))


# models with exact results


@query
def nb_predict(spark, folder):
    table = splits.stratified_holdout(docs(spark, folder), "lang", "doc_id")
    split = table.select("doc_id", "lang", "split")
    counts = terms.term_counts(table, "doc_id", terms.vector_tokens("text"), keep=("lang", "split"))
    model = bayes.fit(counts.where("split = 'train'"), split.where("split = 'train'"), "doc_id", "lang")
    out = bayes.predict(model, counts, split, "doc_id")
    return out.select("doc_id", "prediction", F.round("score", 3).alias("score"))


@query
def knn_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    out = neighbours.knn_predict(
        vectors, vectors, 10, "distance", id_col="vec_id", vec_col="embedding", skip_self=True
    )
    return out.select("id", "prediction", F.round("support", 4).alias("support"))


@query
def class_weights(spark, folder):
    out = vectors.class_weights(docs(spark, folder), "lang")
    return out.select("lang", "n", r6("weight").alias("weight"))


def probabilities(spark, folder) -> DataFrame:
    """Class probabilities from keyword counts: a fixed rule, not a fitted model."""
    words = T.word_tokens("text", WORD)
    rows = scale.balanced(docs(spark, folder)).select("doc_id", "lang", words.alias("w"))

    def hits_of(listed: list[str]) -> Column:
        return F.size(F.filter("w", lambda w: w.isin(listed))) + F.lit(1)

    rows = rows.select("doc_id", "lang", *[hits_of(k).alias(f"h_{c}") for c, k in KEYWORDS.items()])
    rows = rows.withColumn("h_all", sum(F.col(f"h_{c}") for c in KEYWORDS))
    names = F.array(*[F.lit(c) for c in KEYWORDS])
    rows = rows.select(
        "doc_id",
        (F.array_position(names, F.col("lang")) - 1).cast("int").alias("label"),
        F.array(*[F.col(f"h_{c}") / F.col("h_all") for c in KEYWORDS]).alias("probability"),
    )
    return inference.predict_with_reject(rows, threshold=False, out="prediction")


@query
def confusion_matrix(spark, folder):
    return profiles.confusion(probabilities(spark, folder), "label", "prediction")


@query
def f1_scores(spark, folder):
    out = evaluate.f1_scores(probabilities(spark, folder))
    return out.select(*[r6(c).alias(c) for c in ("f1_micro", "f1_macro", "f1_weighted")])


@query
def class_report(spark, folder):
    out = evaluate.class_report(probabilities(spark, folder))
    return out.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def auroc_binned(spark, folder):
    out = evaluate.multiclass_auroc(probabilities(spark, folder), "label", "probability")
    return out.select("class", r6("auroc").alias("auroc"))


@query
def reject_rule(spark, folder):
    return inference.predict_authors(probabilities(spark, folder), ["doc_id"], return_names=True)


@query
def rank_authors(spark, folder):
    out = inference.rank_authors(probabilities(spark, folder), "doc_id")
    return out.select("doc_id", "label", r6("p").alias("p"), "rank")


# usage


def _events(spark, folder):
    return read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query
def registered_users(spark, folder):
    out = usage.registered_users(_events(spark, folder))
    return out.select("user_id", F.col("since.event_id").alias("first_event"))


@query
def user_requests(spark, folder):
    return usage.user_requests(_events(spark, folder))


@query
def user_ratings(spark, folder):
    return usage.user_ratings(_events(spark, folder))


@query
def usage_summary(spark, folder):
    return usage.usage_summary(usage.user_states(_events(spark, folder)))


@query
def running_rating(spark, folder):
    ratings = _events(spark, folder).where(F.col("event_type") == usage.RATING)
    votes = ratings.withColumn("vote", (F.floor("value") % 8).cast("int"))
    out = usage.running_rating(votes.select("event_id", "ts", "vote"), ["ts", "event_id"])
    return out.select("event_id", "vote", "n_votes", r6("mean_vote").alias("mean_vote"))
