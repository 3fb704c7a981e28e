"""Term counts in long form: n-grams, bag of words, TF-IDF, character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.scale import balanced, fits_broadcast, lookup_join, most_counted, rare_rows, settled, stored, unnest

VECTOR_WORD = r"[\p{L}\p{N}_]{2,}"


def ngrams_of(tokens: Column, n_min: int = 1, n_max: int = 1) -> Column:
    """All n-grams of a token array, joined by blanks.

    Pass a column that holds the tokens, not the expression that makes them: it
    is read once per n-gram.
    """

    def of(n: int) -> Column:
        if n == 1:
            return tokens
        starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))

    parts = [of(n) for n in range(n_min, n_max + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def vector_tokens(c: Column | str, pattern: str = VECTOR_WORD) -> Column:
    return T.extract_all(F.lower(F.col(c) if isinstance(c, str) else c), pattern)


def term_counts(
    df: DataFrame, doc: str, tokens: Column, n_min: int = 1, n_max: int = 1, keep: tuple = ()
) -> DataFrame:
    """(doc, term, tf); ``doc`` is the key of the texts, one row each.

    The texts are partitioned by document while compact, so counting per
    (doc, term) needs no shuffle of the exploded tokens.
    """
    rows = df.repartition(doc).select(doc, *keep, tokens.alias("_t"))
    grams = unnest(rows, [doc, *keep], ngrams_of(F.col("_t"), n_min, n_max), "term")
    return grams.groupBy(doc, *keep, "term").agg(F.count("*").alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(term, df, total) over a term count table."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def corpus_ngrams(df: DataFrame, doc: str, tokens: Column, n_min: int, n_max: int) -> DataFrame:
    """(term, df, total) of all n-grams of a corpus.

    A document that is one row names the first of its equal n-grams in that row, so its n-grams are counted by term
    alone and its text is not shuffled; only documents of several rows are counted by document and term first.
    """
    key = F.xxhash64(doc)
    several = settled(df.select(key.alias("_key")).groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"))
    rows = balanced(df).withColumn("_key", key)
    single = rows
    if not several.isEmpty():
        single = lookup_join(rows, several.withColumn("_several", F.lit(True)), ["_key"], "left", salt_on=[doc]).where("_several is null")
    grams = single.select(tokens.alias("_t")).select(F.array_sort(ngrams_of(F.col("_t"), n_min, n_max)).alias("_g"))
    marked = F.transform(
        F.array("_g"),
        lambda g: F.transform(
            g, lambda t, i: F.struct(t.alias("term"), F.when((i > 0) & (t == F.element_at(g, F.greatest(i, F.lit(1)))), 0).otherwise(1).alias("first"))
        ),
    )[0]
    found = unnest(grams, [], marked, "t").select("t.term", F.col("t.first").cast("bigint").alias("df"), F.lit(1).cast("bigint").alias("total"))
    if not several.isEmpty():
        repeated = lookup_join(rows, several, ["_key"], salt_on=[doc])
        counts = term_counts(repeated, doc, tokens, n_min, n_max)
        found = found.unionByName(counts.select("term", F.lit(1).cast("bigint").alias("df"), F.col("tf").alias("total")))
    return found.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(
    counts: DataFrame,
    n_docs: int,
    min_df: float = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """Terms within the document-frequency limits, written once.

    Whole numbers are counts, fractions are shares of the documents.
    ``max_features`` keeps the most frequent terms, ties in term order.
    """
    low = min_df * n_docs if isinstance(min_df, float) else min_df
    high = max_df * n_docs if isinstance(max_df, float) else max_df
    terms = document_frequency(counts).where((F.col("df") >= low) & (F.col("df") <= high))
    if max_features is not None:
        terms = terms.orderBy(F.desc("total"), "term").limit(max_features)
    return settled(terms)


def bag_of_words(counts: DataFrame, terms: DataFrame, doc: str) -> DataFrame:
    """Term counts restricted to a vocabulary, with the document frequency.

    Of a vocabulary too large to broadcast the part with the largest frequencies is, and only the counts of the other terms
    are shuffled, to the rest of it and back to their documents. No copies of the vocabulary are made.
    """
    table = terms.select("term", "df")
    if fits_broadcast(table):
        return counts.join(F.broadcast(table), "term")
    near = most_counted(table, "term", "df").withColumn("_common", F.lit(True))
    near = stored(near.join(table, "term"), "common")
    here = counts.join(F.broadcast(near), "term").drop("_common")
    found = rare_rows(counts, near, "term").join(table, "term").select(here.columns)
    return here.unionByName(found.repartition(doc))


def tfidf(counts: DataFrame, terms: DataFrame, doc: str, n_docs: int) -> DataFrame:
    """Smoothed, L2-normalised weights: tf * (ln((1+n)/(1+df)) + 1)."""
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    return unit_length(bag_of_words(counts, terms, doc).withColumn("weight", F.col("tf") * idf), doc)


def tfidf_log2(counts: DataFrame, terms: DataFrame, doc: str, n_docs: int) -> DataFrame:
    """Unsmoothed, L2-normalised weights for topic corpora: tf * log2(n/df)."""
    idf = F.log2(F.lit(float(n_docs)) / F.col("df"))
    return unit_length(bag_of_words(counts, terms, doc).withColumn("weight", F.col("tf") * idf), doc)


def unit_length(weights: DataFrame, doc: str) -> DataFrame:
    """Divide every weight by the length of its document vector.

    Weights already partitioned by document are not shuffled again.
    """
    squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(doc))
    scaled = F.when(F.col("_sq") > 0, F.col("weight") / F.sqrt("_sq")).otherwise(0.0)
    return weights.withColumn("_sq", squares).withColumn("weight", scaled).drop("_sq")


def grammar_tokens(codes: Column | str) -> Column:
    """Tokens of a grammar code string; case is kept, brackets split tokens."""
    return T.extract_all(codes, fixed.GRAMMAR_TOKEN)


def char_ngrams(
    df: DataFrame,
    doc: str,
    n: int,
    alphabet: str = fixed.RUSSIAN_LETTERS,
    text: str = "text",
    max_tokens: int | None = None,
) -> DataFrame:
    """(doc, pos, gram, n): character n-grams inside each blank-separated token.

    Only n-grams made wholly of the alphabet's letters count. ``max_tokens`` is the input
    length of a fixed-width model; by default all tokens are used. Texts are brought together by
    document while compact; the n-grams of a token are counted in its row, by sorting them.
    """
    texts = df.repartition(doc).groupBy(doc).agg(F.collect_list(F.lower(T.strip(text))).alias("_texts"))

    def tokens(text: Column) -> Column:
        found = F.split(text, " ")
        return found if max_tokens is None else F.slice(found, 1, max_tokens)

    def side_by_side(lists: Column) -> Column:
        places = F.sequence(F.lit(1), F.array_max(F.transform(lists, lambda t: F.size(t))))
        return F.transform(places, lambda i: F.filter(F.transform(lists, lambda t: F.try_element_at(t, i)), lambda w: w.isNotNull()))

    one = F.transform(tokens(F.element_at("_texts", 1)), lambda w: F.array(w))
    several = F.transform(F.array(F.transform("_texts", tokens)), side_by_side)[0]
    lists = F.when(F.size("_texts") == 1, one).when(F.size("_texts") > 1, several)
    rows = unnest(texts, [doc], lists, "tokens", "pos")

    def grams(token: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(token) - (n - 1))
        found = F.transform(starts, lambda i: F.substring(token, i, F.lit(n)))
        return F.filter(found, lambda g: F.translate(g, alphabet, "") == "")

    def counted(ordered: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(ordered))
        begins = F.filter(places, lambda i: (i == 1) | (F.element_at(ordered, i) != F.element_at(ordered, F.greatest(i - 1, F.lit(1)))))
        runs = F.transform(
            F.array(begins),
            lambda b: F.transform(
                b,
                lambda at, k: F.struct(
                    F.element_at(ordered, at).alias("gram"),
                    (F.coalesce(F.try_element_at(b, k + 2), F.size(ordered) + 1) - at).cast("bigint").alias("n"),
                ),
            ),
        )
        return F.when(F.size(ordered) > 0, runs[0])

    long = F.filter("tokens", lambda w: F.length(w) >= n)
    ordered = F.array_sort(F.flatten(F.transform(long, grams)))
    found = F.explode(F.transform(F.array(ordered), counted)[0]).alias("g")
    return rows.where(F.size(long) > 0).select(doc, "pos", found).select(doc, "pos", "g.gram", "g.n")


def known_words(
    df: DataFrame, doc: str, words: DataFrame, text: str = "text", max_tokens: int | None = None
) -> DataFrame:
    """(doc, pos, token) of the tokens found in a word list: the word one-hot."""
    tokens = F.split(F.lower(T.strip(text)), " ")
    if max_tokens is not None:
        tokens = F.slice(tokens, 1, max_tokens)
    rows = unnest(balanced(df), [doc], tokens, "token", "pos")
    listed = words.select(F.col(words.columns[0]).alias("token")).distinct()
    return lookup_join(rows, listed, ["token"], "left_semi", salt_on=[doc, "pos"])


def top_terms(df: DataFrame, tokens: Column, k: int, ties: str = "asc") -> DataFrame:
    """The ``k`` most frequent tokens; ties in term order, rising or falling."""
    return most_frequent(unnest(balanced(df), [], tokens, "term"), "term", k, ties)


def most_frequent(rows: DataFrame, term: str, k: int, ties: str = "asc") -> DataFrame:
    """The ``k`` most frequent values of a column: (term, n)."""
    counted = rows.groupBy(F.col(term).alias("term")).agg(F.count("*").alias("n"))
    tie = F.asc("term") if ties == "asc" else F.desc("term")
    return counted.orderBy(F.desc("n"), tie).limit(k)


def top_ngrams(df: DataFrame, n: int, k: int = 10, text: str = "text") -> DataFrame:
    """The ``k`` most frequent word n-grams; ties in falling term order."""
    rows = balanced(df).select(vector_tokens(text).alias("_t"))
    return top_terms(rows, ngrams_of(F.col("_t"), n, n), k, ties="desc")
