"""Sentence borders with abbreviations, collocations and sentence starters learned from the corpus itself.

The statistics need no labels: an abbreviation is a short type that hardly ever stands without its full stop, a
collocation a pair that meets across a full stop more often than its parts explain, a starter a word that follows sure
sentence ends more often than it occurs. All are log-likelihood ratios over counts of types and pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import text as T
from penprint.operators.scale import balanced, lookup_join, stored

ABBREVIATION = 0.3
COLLOCATION = 7.88
STARTER = 30.0
NUMBER = "##"
OPENERS = "(\"«„“'["
CLOSERS = "\"»”“')],;:"
_QUOTES = r"""["»”“')\]]{0,3}"""


@dataclass
class BorderModel:
    """abbreviations (type, score), collocations (type, next, score), starters (next, score), and how words are written:
    shapes (next, lower, upper_inside)."""

    abbreviations: DataFrame
    collocations: DataFrame
    starters: DataFrame
    shapes: DataFrame


def core(token: Column) -> Column:
    """A token without brackets, quotes and commas around it."""
    return F.rtrim(F.ltrim(token, F.lit(OPENERS)), F.lit(CLOSERS))


def type_of(bare: Column) -> Column:
    """The lower-case type of a bare token without its last full stop; numbers are one type."""
    letters = (bare >= ":") & (bare < "\x80")  # begins with a letter or mark of ASCII, so it is no number
    number = ~letters & bare.rlike(r"^[+-]?\p{Nd}[\p{Nd}.,]*$")
    short = F.when(bare.endswith("."), F.substring(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)
    return F.when(number, F.lit(NUMBER)).otherwise(F.lower(short))


def tokens_of(df: DataFrame, text: str = "text") -> DataFrame:
    """Neighbouring tokens of all texts: type, dot, mark, next, next_upper, next_lower; the last one has no next.

    ``dot`` is a full stop at the end, ``mark`` another sentence end. Only neighbours are looked at, so nothing of a text
    is gathered again.
    """
    words = F.filter(F.split(F.trim(T.repair_spacing(text)), " "), lambda w: w != "")
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"))
    rows = balanced(df.select(text)).select(F.explode(pairs).alias("p")).select(core(F.col("p.a")).alias("a"), core(F.col("p.b")).alias("b"))
    first = F.substring("b", 1, 1)
    return rows.select(
        type_of(F.col("a")).alias("type"), F.col("a").endswith(".").alias("dot"), F.right("a", F.lit(1)).isin("!", "?", "…").alias("mark"),
        type_of(F.col("b")).alias("next"), (first != F.lower(first)).alias("next_upper"), (first != F.upper(first)).alias("next_lower"),
    )


def counts_of(tokens: DataFrame) -> DataFrame:
    """Counts of every type, of every next type, and of all tokens, from one pass: level, word, n, dots, marks, lower,
    upper_inside. ``lower`` and ``upper_inside`` say how a next type was ever written, the latter away from sentence ends.
    """
    inside = ~F.col("dot") & ~F.col("mark") & F.col("next_upper")
    sums = [F.count("*").alias("n"), F.count_if("dot").alias("dots"), F.count_if("mark").alias("marks"), F.max("next_lower").alias("lower"), F.max(inside).alias("upper_inside")]
    sets = tokens.groupingSets([[F.col("type")], [F.col("next")], []], "type", "next").agg(F.grouping_id().alias("_g"), *sums)
    level = F.when(F.col("_g") == 1, "type").when(F.col("_g") == 2, "next").otherwise("all")
    rows = sets.select(level.alias("level"), F.coalesce("type", "next").alias("word"), "n", "dots", "marks", "lower", "upper_inside")
    return stored(rows.where("level = 'all' OR word IS NOT NULL"), "counts")


def abbreviation_score(with_dot: Column, without: Column, kind: Column, dots: Column, tokens: Column) -> Column:
    """How much a type behaves like an abbreviation.

    The ratio compares "its full stops come as often as full stops do anywhere" with "nearly always"; short types,
    inner full stops and few occurrences without the full stop count in its favour.
    """
    n, p, q = with_dot + without, dots / tokens, F.lit(0.99)
    null = with_dot * F.log(p) + F.when(without > 0, without * F.log(1 - p)).otherwise(0.0)
    other = with_dot * F.log(q) + without * F.log(1 - q)
    inner = F.length(kind) - F.length(F.replace(kind, F.lit("."), F.lit("")))
    letters = F.length(kind) - inner
    return -2 * (null - other) * F.exp(-letters) * (inner + 1) * F.pow(letters, -without)


def likelihood_ratio(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Log-likelihood ratio of an event b depending on an event a, from their counts among n."""

    def part(k: Column, m: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(m - k > 0, (m - k) * F.log(1 - p)).otherwise(0.0)

    p, p1, p2 = b / n, both / a, (b - both) / (n - a)
    return -2 * (part(both, a, p) + part(b - both, n - a, p) - part(both, a, p1) - part(b - both, n - a, p2))


def type_scores(counts: DataFrame) -> DataFrame:
    """Abbreviation scores of all types with letters and without digits: type, with_dot, without, score."""
    all_ = counts.where("level = 'all'").select(F.col("dots").alias("_dots"), F.col("n").alias("_tokens"))
    types = counts.where("level = 'type'").select(F.col("word").alias("type"), F.col("dots").alias("with_dot"), (F.col("n") - F.col("dots")).alias("without"))
    fitting = types.where((F.col("with_dot") > 0) & F.col("type").rlike(r"\p{L}") & ~F.col("type").rlike(r"\p{Nd}"))
    score = abbreviation_score(F.col("with_dot"), F.col("without"), F.col("type"), F.col("_dots"), F.col("_tokens"))
    return fitting.join(F.broadcast(all_), F.lit(True)).select("type", "with_dot", "without", score.alias("score"))


def pair_scores(tokens: DataFrame, counts: DataFrame, abbreviations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores of pairs across a full stop after an abbreviation, number or initial, and of words after sure ends.

    Returns (type, next, n_type, n_next, n, score, more) and (next, n_next, n, score, more); ``more`` says that the two
    meet more often than by chance. Only pairs across a full stop after a short type are counted; what follows sure ends
    is the rest of what follows any full stop or mark.
    """
    short = with_abbreviations(tokens.where("dot"), abbreviations).where("short")
    across = stored(short.groupBy("type", "next").agg(F.count("*").alias("n")).where("next IS NOT NULL"), "across")
    total = counts.where("level = 'all'").select(F.col("n").alias("total"))
    by_type = counts.where("level = 'type' AND dots > 0").select(F.col("word").alias("type"), F.col("n").alias("n_type"))
    after = counts.where("level = 'next'").select(F.col("word").alias("next"), F.col("n").alias("n_next"), (F.col("dots") + F.col("marks")).alias("_ends"))
    after = after.where("_ends > 0").join(across.groupBy("next").agg(F.sum("n").alias("_unsure")), "next", "left").na.fill(0, ["_unsure"])
    after = stored(after.select("next", "n_next", (F.col("_ends") - F.col("_unsure")).alias("n")), "after")
    pairs = lookup_join(across.where(F.col("next").rlike(r"\p{L}")), by_type, ["type"], salt_on=["next"])
    pairs = lookup_join(pairs, after.select("next", "n_next"), ["next"], salt_on=["type"]).join(F.broadcast(total), F.lit(True))
    first = F.col("n_type"), F.col("n_next"), F.col("n"), F.col("total")
    collocations = pairs.withColumn("score", likelihood_ratio(*first)).withColumn("more", F.col("n") * F.col("total") > F.col("n_type") * F.col("n_next"))
    starts = after.where((F.col("n") > 0) & F.col("next").rlike(r"^\p{L}+$"))
    starts = starts.join(F.broadcast(total), F.lit(True)).join(F.broadcast(after.agg(F.sum("n").alias("n_ends"))), F.lit(True))
    second = F.col("n_ends"), F.col("n_next"), F.col("n"), F.col("total")
    starters = starts.withColumn("score", likelihood_ratio(*second)).withColumn("more", F.col("n") * F.col("total") > F.col("n_ends") * F.col("n_next"))
    return (
        collocations.select("type", "next", "n_type", "n_next", "n", "score", "more"),
        starters.select("next", "n_next", "n", "score", "more"),
    )


def with_abbreviations(rows: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Adds ``short``: whether a type is a known abbreviation, a number or a single letter."""
    listed = abbreviations.select("type", F.lit(True).alias("_known"))
    joined = lookup_join(rows, listed, ["type"], "left", salt_on=[c for c in rows.columns if c != "type"])
    short = F.coalesce(F.col("_known"), F.lit(False)) | (F.col("type") == NUMBER) | F.col("type").rlike(r"^\p{L}$")
    return joined.withColumn("short", short).drop("_known")


def train(df: DataFrame, text: str = "text") -> BorderModel:
    """Learn a model from a corpus: one pass for the types, one over the full stops for the pairs."""
    tokens = tokens_of(df, text)
    counts = counts_of(tokens)
    abbreviations = stored(type_scores(counts).where(F.col("score") >= ABBREVIATION).select("type", "score"), "abbreviations")
    collocations, starters = pair_scores(tokens, counts, abbreviations)
    shapes = counts.where((F.col("level") == "next") & F.col("word").rlike(r"^\p{L}"))
    return BorderModel(
        abbreviations,
        stored(collocations.where((F.col("score") >= COLLOCATION) & F.col("more")).select("type", "next", "score"), "collocations"),
        stored(starters.where((F.col("score") >= STARTER) & F.col("more")).select("next", "score"), "starters"),
        shapes.select(F.col("word").alias("next"), "lower", "upper_inside"),
    )


def split_sentences(df: DataFrame, model: BorderModel, doc: str, text: str = "text") -> DataFrame:
    """Sentences of every text in order: doc, pos, sentence.

    A text is first cut after every sentence mark that white space follows; white space becomes one space. A border
    after ``!``, ``?`` or the full stop of an ordinary word holds, unless the pair is a collocation. After an
    abbreviation it holds if the next word is a starter, or begins with a capital though it is otherwise written small
    and never large inside a sentence; after a number if the next word does not begin with a small letter; after a
    single letter only in the second of the cases for abbreviations. Texts are spread by document while
    compact, pieces are looked up and joined within that split. A null or empty text has no sentences; rows that share
    a document id are taken as one text.
    """
    pieces = F.split(F.trim(T.repair_spacing(text)), rf"(?<=[.!?…]{_QUOTES}) ")
    rows = df.select(doc, text).repartition(doc)
    rows = rows.select(doc, F.posexplode(pieces).alias("_i", "_piece"), pieces[0].isNull().alias("_null")).drop("_null").where("_piece <> ''")
    within = Window.partitionBy(doc).orderBy("_i")
    before = core(F.element_at(F.split(F.lag("_piece").over(within), " "), -1))
    rows = rows.select(doc, "_i", "_piece", before.alias("_before"), core(F.substring_index("_piece", " ", 1)).alias("_after"))
    first = F.substring("_after", 1, 1)
    rows = rows.select(
        doc, "_i", "_piece", F.col("_before").endswith(".").alias("dot"), type_of(F.col("_before")).alias("type"), type_of(F.col("_after")).alias("next"),
        (first != F.lower(first)).alias("upper"), (first != F.upper(first)).alias("small"),
    )
    no = F.lit(False)
    # only the full stops of short types need a look at the other tables
    short = with_abbreviations(rows.where("dot").select(doc, "_i", "type", "next", "upper", "small"), model.abbreviations)
    paired = lookup_join(rows.where("dot").select(doc, "_i", "type", "next"), model.collocations.select("type", "next"), ["type", "next"], salt_on=[doc, "_i"])
    unsure = lookup_join(short.where("short"), model.starters.select("next", F.lit(True).alias("_starter")), ["next"], "left", salt_on=[doc, "_i"])
    unsure = unsure.join(model.shapes, "next", "left")
    begins = F.col("upper") & F.coalesce(F.col("lower"), no) & ~F.coalesce(F.col("upper_inside"), no)
    starter = F.coalesce(F.col("_starter"), no) & F.col("upper")
    holds = F.when(F.col("type") == NUMBER, ~F.col("small")).when(F.length("type") == 1, begins).otherwise(starter | begins)
    refused = unsure.where(~F.coalesce(holds, no)).select(doc, "_i").unionByName(paired.select(doc, "_i"))
    refused = refused.groupBy(doc).agg(F.collect_set("_i").alias("_no"))
    rows = rows.select(doc, "_i", "_piece").join(refused, doc, "left")
    holds = ~F.coalesce(F.array_contains("_no", F.col("_i")), no)
    number = F.sum(F.when(holds, 1).otherwise(0)).over(within)
    joined = rows.withColumn("_s", number).groupBy(doc, "_s").agg(F.array_sort(F.collect_list(F.struct("_i", "_piece"))).alias("_p"))
    return joined.select(doc, (F.col("_s") - 1).cast("int").alias("pos"), F.array_join("_p._piece", " ").alias("sentence"))
