"""Queries of the language operators: guessed readings, tags in context, trained sentence borders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracles import LEXICON, ORACLES, POS_STATS, TAGS, WORDS, _n as TAG_COLUMNS, q, repaired, split_sentences
from checks.workload import LETTERS, WORD, docs, query
from penprint.functions import fixed, text as T
from penprint.operators import borders, guesser, lexicon, pos, scale, tagger

#: Made-up readings that follow from the last two letters of a form; those of three forms in four are known.
ENDING_WORDS = rf"""
vocab AS (SELECT DISTINCT unnest({WORDS}) AS form FROM documents),
hashed AS (SELECT form, ('0x' || substr(md5(right(form, 2)), 1, 2))::BIGINT AS code FROM vocab),
truth AS (
  SELECT form, regexp_replace(form, '(.)s$', '\1') AS lemma, {TAGS}[1 + code % 8] AS tag,
         {TAGS}[1 + code % 8] || ',n' || CAST(code % 3 AS VARCHAR) || '=x' AS gr
  FROM hashed),
known AS (SELECT * FROM truth WHERE substr(md5(form), 1, 1) < 'c')"""


def ending_lexicon(df: DataFrame) -> DataFrame:
    forms = guesser.corpus_forms(df, pattern=WORD)
    code = F.conv(F.substring(F.md5(F.right(F.col("form"), F.lit(2)).cast("binary")), 1, 2), 16, 10).cast("int")
    tag = F.element_at(F.array(*[F.lit(t) for t in fixed.RATIO_TAGS]), code % 8 + 1)
    gr = F.concat(tag, F.lit(",n"), (code % 3).cast("string"), F.lit("=x"))
    return scale.settled(forms.select("form", F.regexp_replace("form", "(.)s$", "$1").alias("lemma"), tag.alias("tag"), gr.alias("gr")))


def known(truth: DataFrame) -> DataFrame:
    return truth.where(F.substring(F.md5(F.col("form").cast("binary")), 1, 1) < "c")


@query
def ending_counts(spark: SparkSession, folder: str) -> DataFrame:
    return guesser.ending_counts(known(ending_lexicon(docs(spark, folder))))


@query
def guessed_forms(spark: SparkSession, folder: str) -> DataFrame:
    truth = ending_lexicon(docs(spark, folder))
    rules = scale.settled(guesser.ending_rules(guesser.ending_counts(known(truth))))
    unknown = truth.join(known(truth).select("form"), "form", "left_anti")
    return guesser.guess(unknown, rules)


@query
def guess_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    truth = ending_lexicon(docs(spark, folder))
    rules = scale.settled(guesser.ending_rules(guesser.ending_counts(known(truth))))
    unknown = truth.join(known(truth).select("form"), "form", "left_anti")
    return guesser.accuracy(guesser.guess(unknown, rules), truth)


@query
def lemmatized_guessed(spark: SparkSession, folder: str) -> DataFrame:
    table = docs(spark, folder)
    truth = ending_lexicon(table)
    words = guesser.completed(known(truth), truth)
    out = lexicon.lemmatize(table, words, T.word_tokens("text", WORD), "doc_id")
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@query
def grammar_codes_guessed(spark: SparkSession, folder: str) -> DataFrame:
    table = docs(spark, folder)
    truth = ending_lexicon(table)
    words = guesser.completed(known(truth), truth)
    return lexicon.grammar_codes(table, words, "doc_id", alphabet=LETTERS)


_COUNTS = rf"""
{ENDING_WORDS},
changed AS (
  SELECT *, list_max([i FOR i IN range(0, least(length(form), length(lemma)) + 1) IF form[1:i] = lemma[1:i]]) AS kept FROM known),
rules AS (
  SELECT right(form, k) AS ending, tag, gr, length(form) - kept AS cut, substr(lemma, kept + 1) AS add
  FROM changed, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE k < length(form) AND length(form) - kept <= k),
counts AS (SELECT ending, tag, gr, CAST(cut AS INTEGER) AS cut, add, count(*)::BIGINT AS n FROM rules GROUP BY ALL)"""
_GUESSED = rf"""
{_COUNTS},
best AS (
  SELECT *, sum(n) OVER (PARTITION BY ending)::BIGINT AS total FROM counts
  QUALIFY row_number() OVER (PARTITION BY ending ORDER BY n DESC, tag, gr, cut, add) = 1),
guessed AS (
  SELECT form, form[1 : length(form) - cut] || add AS lemma, t.tag, t.gr, t.ending, t.n, t.total
  FROM (SELECT form, k, right(form, k) AS e FROM vocab, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
        WHERE k < length(form) AND form NOT IN (SELECT form FROM known)) f
  JOIN best t ON t.ending = f.e AND t.total >= 2
  QUALIFY row_number() OVER (PARTITION BY form ORDER BY k DESC) = 1)"""

ORACLES["ending_counts"] = f"WITH {_COUNTS} SELECT * FROM counts"
ORACLES["guessed_forms"] = f"WITH {_GUESSED} SELECT * FROM guessed"
ORACLES["guess_accuracy"] = f"""
WITH {_GUESSED}
SELECT CAST(length(ending) AS INTEGER) AS letters, count(*)::BIGINT AS forms, count(*) FILTER (g.lemma = t.lemma)::BIGINT AS right_lemma,
       count(*) FILTER (g.tag = t.tag)::BIGINT AS right_tag, count(*) FILTER (g.gr = t.gr)::BIGINT AS right_gr
FROM guessed g JOIN truth t USING (form) GROUP BY 1"""
_COMPLETED = f"{_GUESSED}, lexicon AS (SELECT * FROM known UNION ALL SELECT form, lemma, tag, gr FROM guessed)"
for _name in ("lemmatized_text", "grammar_codes"):
    ORACLES[_name.replace("_text", "") + "_guessed"] = ORACLES[_name].replace(LEXICON, _COMPLETED)


# tags in context


def tagged_sentences(df: DataFrame) -> DataFrame:
    """Sentences with made-up tags; every third word's tag also hangs on the length of the word before it."""
    sents = scale.unnest(scale.balanced(df), ["doc_id"], T.sentences("text"), "sentence", "pos")
    sents = sents.select("doc_id", "pos", T.word_tokens("sentence", WORD).alias("forms"))
    lengths = F.transform("forms", lambda w: F.length(w))
    before = F.zip_with("forms", F.slice(F.concat(F.array(F.lit(0)), lengths), F.lit(1), F.greatest(F.size("forms"), F.lit(1))), lambda w, n: F.struct(w.alias("w"), n.alias("n")))

    def tag(x):
        code = F.conv(F.substring(F.md5(F.right(x["w"], F.lit(2)).cast("binary")), 1, 2), 16, 10).cast("int")
        odd = F.when(F.length(x["w"]) % 3 == 0, x["n"] % 2).otherwise(0)
        return F.element_at(F.array(*[F.lit(t) for t in fixed.RATIO_TAGS]), (code + odd) % 8 + 1)

    tags = F.transform(F.filter(before, lambda x: x["w"].isNotNull()), tag)
    return scale.stored(sents.select("doc_id", "pos", "forms", tags.alias("tags")), "tagged")


@query
def tags_in_context(spark: SparkSession, folder: str) -> DataFrame:
    truth = tagged_sentences(docs(spark, folder))
    found = tagger.tag_sentences(truth, tagger.learn(truth), "doc_id", out="found")
    return found.select("doc_id", "pos", F.array_join("found", " ").alias("tags"))


@query
def tag_steps(spark: SparkSession, folder: str) -> DataFrame:
    model = tagger.learn(tagged_sentences(docs(spark, folder)))
    names = [*model.tags, "."]
    rows = [(a, b, int(model.steps[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "tag string, next string, cost bigint")


@query
def pos_stats_in_context(spark: SparkSession, folder: str) -> DataFrame:
    table = docs(spark, folder)
    truth = tagged_sentences(table)
    found = tagger.tag_sentences(truth, tagger.learn(truth), "doc_id", out="found")
    out = pos.tag_ratios(tagger.word_rows(found, "doc_id", tags="found"), "doc_id")
    return out.select("doc_id", *[F.round(c, 6).alias(c) for c in pos.POS_STATS])


_TRAIN = rf"""
sents AS (
  SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest([regexp_extract_all(lower(s), '\p{{L}}+') FOR s IN l]) AS forms
  FROM (SELECT doc_id, {split_sentences("text")} AS l FROM documents)),
words AS (
  SELECT doc_id, pos, i, form, {TAGS}[1 + (('0x' || substr(md5(right(form, 2)), 1, 2))::BIGINT + CASE WHEN length(form) % 3 = 0 THEN before % 2 ELSE 0 END) % 8] AS tag
  FROM (SELECT doc_id, pos, i, forms[i] AS form, CASE WHEN i = 1 THEN 0 ELSE length(forms[i - 1]) END AS before
        FROM (SELECT *, unnest(range(1, len(forms) + 1)) AS i FROM sents))),
formtag AS (SELECT form, tag, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT tag, sum(n) AS total FROM formtag GROUP BY tag),
emit AS (SELECT form, tag, CAST(round(-ln(n::DOUBLE / total) * 1000000) AS BIGINT) AS c FROM formtag JOIN totals USING (tag)),
moves AS (
  SELECT coalesce(lag(tag) OVER w, '.') AS tag, tag AS next FROM words WINDOW w AS (PARTITION BY doc_id, pos ORDER BY i)
  UNION ALL SELECT tag, '.' FROM words QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY i DESC) = 1),
names AS (SELECT DISTINCT tag FROM words UNION ALL SELECT '.'),
steps AS (
  SELECT a.tag, b.tag AS next, CAST(round(-ln((count(m.tag) + 1)::DOUBLE / (sum(count(m.tag)) OVER (PARTITION BY a.tag) + (SELECT count(*) FROM names))) * 1000000) AS BIGINT) AS cost
  FROM names a CROSS JOIN names b LEFT JOIN moves m ON m.tag = a.tag AND m.next = b.tag GROUP BY a.tag, b.tag)"""
_PATHS = f"""{_TRAIN},
best AS (
  SELECT w.doc_id, w.pos, w.i, e.tag, {{'cost': s.cost + e.c, 'before': '', 'path': e.tag}} AS b
  FROM words w JOIN emit e USING (form) JOIN steps s ON s.tag = '.' AND s.next = e.tag WHERE w.i = 1
  UNION ALL
  SELECT w.doc_id, w.pos, w.i, e.tag, min({{'cost': b.b.cost + s.cost + e.c, 'before': b.tag, 'path': b.b.path || ' ' || e.tag}})
  FROM best b JOIN words w ON w.doc_id = b.doc_id AND w.pos = b.pos AND w.i = b.i + 1
  JOIN emit e ON e.form = w.form JOIN steps s ON s.tag = b.tag AND s.next = e.tag GROUP BY w.doc_id, w.pos, w.i, e.tag),
done AS (
  SELECT b.doc_id, b.pos, min({{'cost': b.b.cost + s.cost, 'tag': b.tag, 'path': b.b.path}}) AS b
  FROM best b JOIN (SELECT doc_id, pos, max(i) AS n FROM words GROUP BY ALL) l ON l.doc_id = b.doc_id AND l.pos = b.pos AND l.n = b.i
  JOIN steps s ON s.tag = b.tag AND s.next = '.' GROUP BY ALL)"""
ORACLES["tag_steps"] = f"WITH {_TRAIN} SELECT tag, next, cost FROM steps"
ORACLES["tags_in_context"] = f"""
WITH RECURSIVE {_PATHS} SELECT s.doc_id, s.pos, coalesce(d.b.path, '') AS tags FROM sents s LEFT JOIN done d USING (doc_id, pos)"""
_FOUND = "tagged AS (SELECT doc_id, unnest(string_split(b.path, ' ')) AS tag FROM done)"
_TAGGED = ", ".join(f"count(*) FILTER (WHERE tag = {q(t)}) AS {c}" for t, c in TAG_COLUMNS.items())
ORACLES["pos_stats_in_context"] = f"""
WITH RECURSIVE {_PATHS}, {_FOUND},
tag_counts AS (SELECT s.doc_id, count(tag) AS n_all, {_TAGGED} FROM (SELECT DISTINCT doc_id FROM sents) s LEFT JOIN tagged USING (doc_id) GROUP BY s.doc_id)
SELECT doc_id, {POS_STATS} FROM tag_counts"""


# trained sentence borders


@query
def abbreviation_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = borders.type_scores(borders.counts_of(borders.tokens_of(docs(spark, folder))))
    return scores.select("type", "with_dot", "without", (F.round("score", 5) + 0.0).alias("score"))


@query
def border_pairs(spark: SparkSession, folder: str) -> DataFrame:
    tokens = borders.tokens_of(docs(spark, folder))
    counts = borders.counts_of(tokens)
    short = scale.settled(borders.type_scores(counts).where(F.col("score") >= borders.ABBREVIATION))
    pairs, starters = borders.pair_scores(tokens, counts, short)
    pairs = pairs.select("type", "next", "n", F.round("score", 5).alias("score"), "more")
    return pairs.unionByName(starters.select(F.lit("").alias("type"), "next", "n", F.round("score", 5).alias("score"), "more"))


@query
def trained_sentences(spark: SparkSession, folder: str) -> DataFrame:
    table = docs(spark, folder)
    return borders.split_sentences(table, borders.train(table), "doc_id")


def _core(sql: str) -> str:
    openers, closers = q(r"""^[("«„“'\[]+"""), q(r"""["»”“')\],;:]+$""")
    return f"regexp_replace(regexp_replace({sql}, {openers}, ''), {closers}, '')"


def _type(sql: str) -> str:
    return rf"CASE WHEN regexp_matches({sql}, '^[+-]?\p{{Nd}}[\p{{Nd}}.,]*$') THEN '##' ELSE lower(regexp_replace({sql}, '\.$', '')) END"


_LIST = f"[w FOR w IN string_split(trim({repaired('text')}, ' '), ' ') IF w <> '']"
_TOKENS = rf"""
toklist AS (SELECT doc_id, {_LIST} AS w FROM documents),
raw AS (SELECT doc_id, i, w[i] AS token, {_core('w[i]')} AS a, {_core('w[i + 1]')} AS b FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM toklist)),
toks AS (
  SELECT doc_id, i, token, {_type('a')} AS type, suffix(a, '.') AS dot, regexp_matches(a, '[!?…]$') AS mark, {_type('b')} AS next,
         substr(b, 1, 1) <> lower(substr(b, 1, 1)) AS next_upper, substr(b, 1, 1) <> upper(substr(b, 1, 1)) AS next_lower
  FROM raw),
kinds AS (SELECT type, count(*) FILTER (dot)::BIGINT AS with_dot, count(*) FILTER (NOT dot)::BIGINT AS without FROM toks GROUP BY type),
every AS (SELECT sum(with_dot)::DOUBLE / sum(with_dot + without) AS p, sum(with_dot + without)::BIGINT AS total FROM kinds),
shaped AS (SELECT *, length(type) - length(replace(type, '.', '')) AS inner_dots, length(replace(type, '.', '')) AS letters FROM kinds
  WHERE with_dot > 0 AND regexp_matches(type, '\p{{L}}') AND NOT regexp_matches(type, '\p{{Nd}}')),
scores AS (
  SELECT type, with_dot, without,
         -2 * ((with_dot * ln(p) + CASE WHEN without > 0 THEN without * ln(1 - p) ELSE 0 END) - (with_dot * ln(0.99::DOUBLE) + without * ln(1 - 0.99::DOUBLE)))
         * exp(-letters) * (inner_dots + 1) * pow(letters, -without) AS score
  FROM shaped, every)"""


def _ratio(a: str, b: str, both: str, n: str) -> str:
    def part(k: str, m: str, p: str) -> str:
        return f"(CASE WHEN {k} > 0 THEN ({k}) * ln({p}) ELSE 0 END + CASE WHEN ({m}) - ({k}) > 0 THEN (({m}) - ({k})) * ln(1 - {p}) ELSE 0 END)"

    rest, other = f"({b} - {both})", f"({n} - {a})"
    p, p1, p2 = f"({b}::DOUBLE / {n})", f"({both}::DOUBLE / {a})", f"({rest}::DOUBLE / {other})"
    return f"-2 * ({part(both, a, p)} + {part(rest, other, p)} - {part(both, a, p1)} - {part(rest, other, p2)})"


_PAIRS = rf"""{_TOKENS},
shorts AS (SELECT t.*, coalesce(s.score >= 0.3, false) OR t.type = '##' OR regexp_matches(t.type, '^\p{{L}}$') AS short FROM toks t LEFT JOIN scores s USING (type)),
by_type AS (SELECT type, count(*)::BIGINT AS n_type FROM toks GROUP BY type),
by_next AS (SELECT next, count(*)::BIGINT AS n_next FROM toks WHERE next IS NOT NULL GROUP BY next),
across AS (SELECT type, next, count(*)::BIGINT AS n FROM shorts WHERE dot AND short AND regexp_matches(next, '\p{{L}}') GROUP BY type, next),
collocs AS (
  SELECT type, next, n, {_ratio('n_type', 'n_next', 'n', 'total')} AS score, n * total > n_type * n_next AS more
  FROM across JOIN by_type USING (type) JOIN by_next USING (next), every),
ends AS (SELECT next FROM shorts WHERE (mark OR dot AND NOT short) AND next IS NOT NULL),
starts AS (
  SELECT next, n, {_ratio('n_ends', 'n_next', 'n', 'total')} AS score, n * total > n_ends * n_next AS more
  FROM (SELECT next, count(*)::BIGINT AS n FROM ends WHERE regexp_matches(next, '^\p{{L}}+$') GROUP BY next) JOIN by_next USING (next),
       every, (SELECT count(*)::BIGINT AS n_ends FROM ends))"""
ORACLES["abbreviation_scores"] = f"WITH {_TOKENS} SELECT type, with_dot, without, round(score, 5) + 0.0::DOUBLE AS score FROM scores"
ORACLES["border_pairs"] = f"""
WITH {_PAIRS} SELECT type, next, n, round(score, 5) AS score, more FROM collocs
UNION ALL SELECT '', next, n, round(score, 5), more FROM starts"""
ORACLES["trained_sentences"] = rf"""
WITH {_PAIRS},
shapes AS (
  SELECT next, bool_or(next_lower) AS small, bool_or(NOT dot AND NOT mark AND next_upper) AS inside FROM toks WHERE regexp_matches(next, '^\p{{L}}') GROUP BY next),
cuts AS (
  SELECT t.doc_id, t.i, t.token,
         regexp_matches(t.token, '[.!?…]["»”“'')\]]{{0,3}}$') AND CASE
           WHEN NOT t.dot THEN true WHEN c.type IS NOT NULL THEN false WHEN NOT t.short THEN true WHEN t.type = '##' THEN NOT t.next_lower
           WHEN length(t.type) = 1 THEN t.next_upper AND coalesce(s.small, false) AND NOT coalesce(s.inside, false)
           ELSE t.next_upper AND (b.next IS NOT NULL OR coalesce(s.small, false) AND NOT coalesce(s.inside, false)) END AS holds
  FROM shorts t LEFT JOIN (SELECT type, next FROM collocs WHERE score >= 7.88 AND more) c ON c.type = t.type AND c.next = t.next
  LEFT JOIN (SELECT next FROM starts WHERE score >= 30 AND more) b ON b.next = t.next LEFT JOIN shapes s ON s.next = t.next)
SELECT doc_id, CAST(g AS INTEGER) AS pos, string_agg(token, ' ' ORDER BY i) AS sentence FROM (
  SELECT doc_id, i, token, coalesce(sum(CASE WHEN holds THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g
  FROM cuts) GROUP BY doc_id, g"""
