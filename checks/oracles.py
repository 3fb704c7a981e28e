"""The same results in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from penprint.functions import fixed
from checks.workload import KEYWORDS, STOP

ORACLES: dict[str, str] = {}


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# building blocks

WORDS = r"regexp_extract_all(lower(text), '\p{L}+')"
VECTOR_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
TAGS = "[" + ", ".join(q(t) for t in fixed.RATIO_TAGS) + "]"
LEXICON = rf"""
vocab AS (SELECT DISTINCT unnest({WORDS}) AS form FROM documents),
tagged AS (SELECT form, {TAGS}[1 + length(form) % 8] AS tag FROM vocab),
lexicon AS (
  SELECT form, regexp_replace(form, '(.)s$', '\1') AS lemma, tag,
         tag || ',n' || CAST(length(form) % 3 AS VARCHAR) || '=x' AS gr
  FROM tagged)"""


def strip(sql: str) -> str:
    return rf"regexp_replace({sql}, '^\s+|\s+$', '', 'g')"


def tokens_of(source: str, tokens: str, keep: str = "doc_id") -> str:
    """Rows (keep, pos, token) of a list expression."""
    return (
        f"SELECT {keep}, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS token "
        f"FROM (SELECT {keep}, {tokens} AS l FROM {source})"
    )


NO_NUMBERS = r"regexp_replace({}, '\p{{Nd}}+', '', 'g')".format
NO_LINKS_RAW = r"regexp_replace({}, '\s*https?://t.co/[A-Za-zа-яА-Я0-9]*\s*', ' ', 'g')".format
MARK_CLASS = r"""'[!()\[\]{};«№»:''",`<>./?@=#$%^&*~]'"""


def no_links(sql: str) -> str:
    return strip(NO_LINKS_RAW(sql))


def no_marks(sql: str) -> str:
    return strip(rf"regexp_replace(regexp_replace({sql}, {MARK_CLASS}, ' ', 'g'), '\s+', ' ', 'g')")


def no_short_words(sql: str) -> str:
    chunks = rf"regexp_extract_all({sql}, '[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_]+')"
    kept = (
        rf"[CASE WHEN length(c) <= 2 AND regexp_matches(c, '^[\p{{L}}\p{{M}}\p{{N}}_]') "
        rf"THEN ' ' ELSE c END FOR c IN {chunks}]"
    )
    return strip(rf"regexp_replace(array_to_string({kept}, ''), '\s{{2,}}', ' ', 'g')")


def cleaned(sql: str) -> str:
    return rf"""regexp_replace({sql}, '[^\p{{L}} \-"!''(),.:;?]', '', 'g')"""


def repaired(sql: str) -> str:
    w = r"[\p{L}\p{M}\p{N}_]"
    return rf"regexp_replace(regexp_replace({sql}, '\s+', ' ', 'g'), '({w})([.:])({w})', '\1\2 \3', 'g')"


def for_morph(sql: str) -> str:
    return rf"regexp_replace(regexp_replace({sql}, '[^\p{{L}} \-]', '', 'g'), '\s?-\s|\s-\s?', ' ', 'g')"


def encoded(sql: str, scheme: str) -> str:
    for mark, code in fixed.MARK_CODES[scheme]:
        sql = f"replace({sql}, {q(mark)}, {q(f' {code} ')})"
    return rf"regexp_replace({sql}, '\s?-\s|\s-\s?', ' {fixed.FREE_DASH_CODE[scheme]} ', 'g')"


def split_sentences(sql: str) -> str:
    pieces = rf"string_split(regexp_replace({sql}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
    return f"[s FOR s IN {pieces} IF s <> '']"


SENTENCES = f"""
sents AS (
  SELECT doc_id, lang, source, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence
  FROM (SELECT doc_id, lang, source, {split_sentences(strip(repaired("text")))} AS l FROM documents)),
counted AS (
  SELECT *, CAST(len([w FOR w IN string_split_regex(sentence, '\\s+') IF w <> '']) AS INTEGER) AS n_words
  FROM sents)"""

# sources and catalogue

ORACLES["split_author_prefix"] = """
WITH raw AS (
  SELECT doc_id, 'author_id_' || CASE WHEN length(a) < 2 THEN '0' || a ELSE a END || text AS value
  FROM (SELECT *, regexp_extract(source, '([0-9]+)$', 1) AS a FROM documents))
SELECT doc_id, substring(value, 1, 12) AS target, substring(value, 13) AS text FROM raw"""

ORACLES["author_catalogue"] = """
SELECT CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS author_id, max(source) AS author
FROM documents GROUP BY 1"""

_entities = "t"
for _name, _char in [("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " "), ("amp", "&")]:
    _entities = f"replace({_entities}, '&{_name};', {q(_char)})"
PAGE_TEXT = rf"""
bare AS (
  SELECT page_id, url, regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS h FROM pages),
blocks AS (
  SELECT page_id, url, array_to_string(
    regexp_extract_all(h, '(?is)<p(?:\s[^>]*)?>(.*?)(?:</p\s*>|\z)', 1), '') AS b FROM bare),
untagged AS (
  SELECT page_id, url, regexp_replace(b, '<[A-Za-z/!?][^>]*>', '', 'g') AS t FROM blocks),
texts AS (SELECT page_id, url, {_entities} AS text FROM untagged)"""
ORACLES["extract_pages"] = f"WITH {PAGE_TEXT} SELECT page_id, text FROM texts"

PAGE_KEY = "regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+/[0-9]+)', 1)"
ORACLES["assemble_works"] = rf"""
WITH {PAGE_TEXT},
placed AS (
  SELECT {PAGE_KEY} AS work, page_id, text,
         coalesce(TRY_CAST(regexp_extract(url, '[?&]page=([0-9]+)', 1) AS INTEGER), 1) AS page
  FROM texts)
SELECT work, string_agg(text, '' ORDER BY page, page_id) AS text, count(*) AS n_pages FROM placed GROUP BY work"""
ORACLES["ordered_pages"] = rf"""
WITH {PAGE_TEXT},
placed AS (
  SELECT {PAGE_KEY} AS work, page_id, text,
         coalesce(TRY_CAST(regexp_extract(url, '[?&]page=([0-9]+)', 1) AS INTEGER), 1) AS page
  FROM texts)
SELECT work, row_number() OVER (PARTITION BY work ORDER BY page, page_id) - 1 AS place, text FROM placed"""

ORACLES["plan_titles"] = f"""
SELECT title, title IN (SELECT lang || '/' || CAST(doc_id AS VARCHAR) FROM documents) AS known
FROM (SELECT DISTINCT {PAGE_KEY} AS title FROM pages)"""

ORACLES["author_ids"] = """
WITH firsts AS (SELECT source, min(doc_id) AS first_seen FROM documents GROUP BY source),
ids AS (SELECT *, CAST(row_number() OVER (ORDER BY first_seen) - 1 AS INTEGER) AS author_id FROM firsts)
SELECT *, 'author_id_' || CASE WHEN author_id < 10 THEN '0' ELSE '' END || CAST(author_id AS VARCHAR) AS prefix,
       author_id AS target
FROM ids"""

# text scalars

ORACLES["clean_text"] = f"""
SELECT doc_id, lower(text) AS lowered, {NO_NUMBERS("text")} AS no_numbers,
       {no_links("text")} AS no_links, {no_marks("text")} AS no_marks FROM documents"""

ORACLES["clean_sentence"] = f"""
SELECT doc_id, {cleaned("text")} AS cleaned, {repaired("text")} AS repaired, {for_morph("text")} AS for_morph
FROM documents"""

ORACLES["encode_punct"] = f"SELECT doc_id, {encoded('text', 'core')} AS coded FROM documents"
ORACLES["encode_punct_verbose"] = f"SELECT doc_id, {encoded('text', 'verbose')} AS coded FROM documents"
ORACLES["remove_short_words"] = f"SELECT doc_id, {no_short_words('text')} AS long_words FROM documents"

ORACLES["word_tokens"] = f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, array_to_string(w, ' ') AS tokens,
       array_to_string([x FOR x IN w IF x NOT IN {listed(STOP)}], ' ') AS kept
FROM (SELECT doc_id, {WORDS} AS w FROM documents)"""

MARKS = r"regexp_extract_all(text, '(?:\.{3})|[.,—?«:!;]')"
ORACLES["punct_tokens"] = f"""
SELECT doc_id, CAST(len(m) AS INTEGER) AS n_marks, array_to_string(m, ' ') AS marks
FROM (SELECT doc_id, {MARKS} AS m FROM documents)"""

ORACLES["sentences"] = f"""
SELECT doc_id, pos, token AS sentence FROM ({tokens_of("documents", split_sentences("text"))})"""

ORACLES["lemmatized_text"] = f"""
WITH {LEXICON}, toks AS ({tokens_of("documents", WORDS)}),
joined AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS lemmas
  FROM toks LEFT JOIN lexicon ON form = token GROUP BY doc_id)
SELECT d.doc_id, coalesce(lemmas, '') AS lemmas FROM documents d LEFT JOIN joined USING (doc_id)"""

CHUNKS = r"regexp_extract_all({}, '[\p{{L}}]+(?:-[\p{{L}}]+)*|[^\p{{L}}]+')".format


def recipe(number: int) -> str:
    """CTEs r<number>(doc_id, t): cleaned, lemmatised, filtered and joined."""
    short, marks, stops, length = {
        1: (True, True, True, 3), 2: (True, False, True, 3), 3: (False, True, True, 0), 4: (False, True, False, 0)
    }[number]
    sql = f"lower({no_links(NO_NUMBERS('text'))})"
    sql = no_short_words(sql) if short else sql
    sql = no_marks(sql) if marks else sql
    rules = [r"x <> ' '", r"NOT regexp_matches(x, '^\p{Nd}+$')"]
    if length:
        rules.append(f"length(x) >= {length}")
    if marks:
        rules.append(f"NOT contains({q(fixed.ASCII_MARKS)}, {strip('x')})")
    if stops:
        rules.append(f"x NOT IN {listed(STOP)}")
    return f"""
t{number} AS ({tokens_of("documents", CHUNKS(sql))}),
l{number} AS (SELECT doc_id, pos, coalesce(lemma, token) AS x FROM t{number} LEFT JOIN lexicon ON form = lower(token)),
r{number} AS (SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS t FROM l{number} WHERE {" AND ".join(rules)} GROUP BY doc_id)"""


ORACLES["preprocess_recipes"] = (
    f"WITH {LEXICON}, {', '.join(recipe(i) for i in (1, 2, 3, 4))} SELECT d.doc_id, "
    + ", ".join(f"coalesce(r{i}.t, '') AS text_preproc{i}" for i in (1, 2, 3, 4))
    + " FROM documents d "
    + " ".join(f"LEFT JOIN r{i} ON r{i}.doc_id = d.doc_id" for i in (1, 2, 3, 4))
)

CODES = [code for _, code in fixed.MARK_CODES["core"]] + ["DSH"]


def grammar(full: bool) -> str:
    gr = "gr" if full else "split_part(gr, '=', 1)"
    tokens = rf"regexp_extract_all({encoded(cleaned('text'), 'core')}, '[\p{{L}}A-Z]+(?:-[\p{{L}}A-Z]+)*')"
    return f"""
toks AS ({tokens_of("documents", tokens)}),
coded AS (
  SELECT doc_id, pos, CASE WHEN token IN {listed(CODES)} THEN token ELSE {gr} END AS code
  FROM toks LEFT JOIN lexicon ON form = lower(token)),
joined AS (SELECT doc_id, string_agg(code, ' ' ORDER BY pos) AS c FROM coded WHERE code IS NOT NULL GROUP BY doc_id),
codes AS (SELECT d.doc_id, coalesce(c, '') AS codes FROM documents d LEFT JOIN joined USING (doc_id))"""


ORACLES["grammar_codes"] = f"WITH {LEXICON}, {grammar(True)} SELECT doc_id, codes FROM codes"
ORACLES["grammar_codes_brief"] = f"WITH {LEXICON}, {grammar(False)} SELECT doc_id, codes FROM codes"

_names = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in fixed.AUTHOR_NAMES.items())
ORACLES["label_names"] = f"""
SELECT doc_id, lang AS language, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id, author_id,
       CASE author_id {_names} END AS name
FROM (SELECT *, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 11 - 1 AS author_id FROM documents)"""

# features

_mark_counts = ", ".join(
    f"CAST(len([x FOR x IN m IF x = {q(mark)}]) AS INTEGER) AS {name}" for mark, name in fixed.TEXT_MARKS.items()
)
SENT_STATS = f"""
marks AS (SELECT doc_id, text, {MARKS} AS m FROM documents),
mark_counts AS (SELECT doc_id, length(text) AS n, len(m) AS n_marks, {_mark_counts} FROM marks),
sent_stats AS (
  SELECT *, CASE WHEN period + exclam + question + ellipsis > 0
    THEN n::DOUBLE / (period + exclam + question + ellipsis) ELSE n::DOUBLE END AS avg_snt FROM mark_counts)"""
TOKEN_STATS = f"""
word_lists AS (SELECT doc_id, {WORDS} AS w FROM documents),
token_stats AS (
  SELECT doc_id, len(w) AS n_words,
    CASE WHEN len(w) > 0 THEN list_sum([length(x) FOR x IN w])::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS avg_tkn,
    CASE WHEN len(w) > 0 THEN len(list_distinct(w))::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS type_ratio
  FROM word_lists)"""
_n = {t: "n_" + t.lower().replace("-", "_") for t in fixed.RATIO_TAGS}
TAG_COUNTS = f"""
toks AS ({tokens_of("documents", WORDS, "doc_id, source")}),
tag_counts AS (
  SELECT d.source, d.doc_id, count(token) AS n_all, {", ".join(f"count(*) FILTER (WHERE tag = {q(t)}) AS {c}" for t, c in _n.items())}
  FROM documents d LEFT JOIN toks USING (doc_id) LEFT JOIN lexicon ON form = token GROUP BY d.source, d.doc_id)"""


def ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {top} <> 0 AND {bottom} <> 0 THEN ({top})::DOUBLE / {bottom} ELSE 0.0::DOUBLE END"


POS_STATS = ",\n".join(
    f"round({ratio(top, bottom)}, 6) AS {name}"
    for name, top, bottom in [
        ("noun2verb", _n["S"], _n["V"]), ("adj2noun", _n["A"], _n["S"]), ("adv2verb", _n["ADV"], _n["V"]),
        ("pr2noun", _n["PR"], _n["S"]), ("conj2noun", _n["CONJ"], _n["S"]),
        ("pron2noun", f"({_n['S-PRO']} + {_n['A-PRO']})", _n["S"]), ("verb2word", _n["V"], "n_all"),
    ]
)
_marks = ", ".join(fixed.TEXT_MARKS.values())
ORACLES["sent_stats"] = f"WITH {SENT_STATS} SELECT doc_id, {_marks}, round(avg_snt, 6) AS avg_snt_len FROM sent_stats"
ORACLES["token_stats"] = (
    f"WITH {TOKEN_STATS} SELECT doc_id, round(avg_tkn, 6) AS avg_tkn_len, round(type_ratio, 6) AS ttr FROM token_stats"
)
ORACLES["pos_stats"] = f"WITH {LEXICON}, {TAG_COUNTS} SELECT doc_id, {POS_STATS} FROM tag_counts"
ORACLES["text_stats"] = f"""
WITH {LEXICON}, {SENT_STATS}, {TOKEN_STATS}, {TAG_COUNTS}
SELECT s.doc_id, {_marks}, round(avg_snt, 6) AS avg_snt_len, round(avg_tkn, 6) AS avg_tkn_len,
       round(type_ratio, 6) AS ttr,
       round(CASE WHEN n_words > 0 THEN n_marks::DOUBLE / n_words ELSE 0.0::DOUBLE END, 6) AS punct2word, {POS_STATS}
FROM sent_stats s JOIN token_stats t ON t.doc_id = s.doc_id JOIN tag_counts c ON c.doc_id = s.doc_id"""

PROFILE = f"""
lists AS (
  SELECT doc_id, text, [w FOR w IN string_split_regex(text, '\\s+') IF w <> ''] AS w, {split_sentences("text")} AS s
  FROM documents),
profile AS (
  SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars_total, CAST(len(w) AS INTEGER) AS word_count,
    CASE WHEN len(w) > 0 THEN list_sum([length(x) FOR x IN w])::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS mwl,
    CASE WHEN len(s) > 0 THEN list_sum([length(x) FOR x IN s])::DOUBLE / len(s) ELSE 0.0::DOUBLE END AS msl
  FROM lists)"""
ORACLES["text_profile"] = f"""
WITH {PROFILE} SELECT doc_id, n_chars_total, word_count, round(mwl, 6) AS mean_word_length,
round(msl, 6) AS mean_sent_length FROM profile"""

BASIC = rf"""
prepared AS (SELECT doc_id, source, text, {WORDS} AS w, {split_sentences("text")} AS s FROM documents),
syllabled AS (SELECT *, [length(regexp_replace(x, '[^{fixed.LATIN_VOWELS}]', '', 'g')) FOR x IN w] AS y FROM prepared),
raw_basic AS (
  SELECT doc_id, source, text, len(s) AS n_sents, len(w) AS n_words, len(list_distinct(w)) AS n_unique_words,
    len([x FOR x IN w IF length(x) >= 6]) AS n_long_words, len([x FOR x IN y IF x >= 4]) AS n_complex_words,
    len([x FOR x IN y IF x BETWEEN 1 AND 3]) AS n_simple_words, len([x FOR x IN y IF x = 1]) AS n_monosyllable_words,
    len([x FOR x IN y IF x > 1]) AS n_polysyllable_words, length(replace(text, chr(10), '')) AS n_chars,
    length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS n_letters,
    length(text) - length(replace(text, ' ', '')) AS n_spaces, coalesce(list_sum(y), 0) AS n_syllables,
    length(text) - length(regexp_replace(text, '[!-/:-@\[-`{{-~«»—…№]', '', 'g')) AS n_punctuations
  FROM syllabled),"""
_basic = [
    "n_sents", "n_words", "n_unique_words", "n_long_words", "n_complex_words", "n_simple_words",
    "n_monosyllable_words", "n_polysyllable_words", "n_chars", "n_letters", "n_spaces", "n_syllables", "n_punctuations",
]
BASIC += (
    "basic AS (SELECT doc_id, source, "
    + ", ".join(rf"CASE WHEN regexp_matches(text, '[\p{{L}}\p{{N}}_]') THEN CAST({c} AS INTEGER) END AS {c}" for c in _basic)
    + " FROM raw_basic)"
)
ORACLES["basic_stats"] = f"WITH {BASIC} SELECT * EXCLUDE (source) FROM basic"

_sentence_marks = ", ".join(
    f"CAST(length(sentence) - length(replace(sentence, {q(mark)}, '')) AS INTEGER) AS {name}"
    for mark, name in fixed.SENTENCE_MARKS.items()
)
ORACLES["sentence_stats"] = f"WITH {SENTENCES} SELECT doc_id, pos, n_words, {_sentence_marks} FROM counted"

ORACLES["pos_shares"] = f"""
WITH {LEXICON}, toks AS ({tokens_of("documents", WORDS)}),
c AS (SELECT doc_id, tag, count(*) AS n FROM toks JOIN lexicon ON form = token GROUP BY doc_id, tag)
SELECT doc_id, tag, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY doc_id), 6) AS share FROM c"""

ORACLES["pos_examples"] = f"""
WITH {LEXICON}, toks AS ({tokens_of("documents", WORDS)}),
f AS (
  SELECT tag, token, doc_id, pos, row_number() OVER (PARTITION BY token ORDER BY doc_id, pos) AS rn
  FROM toks JOIN lexicon ON form = token)
SELECT tag, CAST(row_number() OVER (PARTITION BY tag ORDER BY doc_id, pos) AS INTEGER) AS rank, token
FROM f WHERE rn = 1 QUALIFY rank <= 5"""


def grams(list_sql: str, source: str, n_min: int, n_max: int, keep: str = "doc_id") -> str:
    parts = [
        f"SELECT {keep}, array_to_string(list_slice(l, i, i + {n - 1}), ' ') AS term "
        f"FROM (SELECT {keep}, l, unnest(range(1, len(l) - {n - 2})) AS i FROM src)"
        for n in range(n_min, n_max + 1)
    ]
    return f"src AS (SELECT {keep}, {list_sql} AS l FROM {source}),\ngrams AS ({' UNION ALL '.join(parts)})"


CORPUS = """
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term)"""
ORACLES["ngram_counts"] = f"""
WITH {grams(VECTOR_WORDS, "documents", 1, 3)}, {CORPUS} SELECT term, df, total FROM dfs"""
ORACLES["bow_filtered"] = f"""
WITH {grams(VECTOR_WORDS, "documents", 1, 1)}, {CORPUS}
SELECT term, doc_id, tf, df FROM tf JOIN dfs USING (term)
WHERE df >= 5 AND df <= 0.5 * (SELECT count(*) FROM documents)"""
ORACLES["tfidf_terms"] = f"""
WITH {grams(VECTOR_WORDS, "documents", 1, 1)}, {CORPUS},
w AS (
  SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS w
  FROM tf JOIN dfs USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""
GRAMMAR_TOKENS = r"regexp_extract_all(codes, '\b[a-zA-Zа-яА-ЯёЁ0-9,=|\-]+\b')"
ORACLES["grammar_bow"] = f"""
WITH {LEXICON}, {grammar(True)}, {grams(GRAMMAR_TOKENS, "codes", 1, 3)}, {CORPUS} SELECT term, df, total FROM dfs"""

ORACLES["char_bigrams"] = f"""
WITH toks AS ({tokens_of("documents", f"string_split(lower({strip('text')}), ' ')")}),
pairs AS (SELECT doc_id, pos, substring(token, i, 2) AS gram
  FROM (SELECT doc_id, pos, token, unnest(range(1, length(token))) AS i FROM toks)),
c AS (SELECT doc_id, pos, gram, count(*) AS n FROM pairs
  WHERE regexp_matches(gram, '^[a-zàâäáéèêëíîïóôöúùûüœæçñß]{{2}}$') GROUP BY ALL)
SELECT doc_id, gram, CAST(sum(n) AS BIGINT) AS total, count(*) AS n_positions, max(n) AS most FROM c GROUP BY doc_id, gram"""

ORACLES["clip_p99"] = f"""
WITH {PROFILE},
top AS (SELECT quantile_cont(n_chars_total::DOUBLE, 0.99) AS a, quantile_cont(word_count::DOUBLE, 0.99) AS b,
  quantile_cont(mwl, 0.99) AS c FROM profile)
SELECT doc_id, round(least(n_chars_total::DOUBLE, a), 6) AS n_chars_total, round(least(word_count::DOUBLE, b), 6) AS word_count,
       round(least(mwl, c), 6) AS mean_word_length FROM profile, top"""

# profiles

ORACLES["class_distribution"] = """
SELECT lang, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY lang"""
ORACLES["profile_mean"] = (
    f"WITH {BASIC} SELECT source, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _basic) + " FROM basic GROUP BY source"
)
ORACLES["profile_median"] = (
    f"WITH {BASIC} SELECT source, "
    + ", ".join(f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS {c}" for c in _basic)
    + " FROM basic GROUP BY source"
)
_share_rows = " UNION ALL ".join(
    f"SELECT doc_id, source, {q(t)} AS tag, CASE WHEN n_all > 0 THEN {c}::DOUBLE / n_all ELSE 0.0::DOUBLE END AS share FROM tag_counts"
    for t, c in _n.items()
)
ORACLES["pos_median_profile"] = f"""
WITH {LEXICON}, {TAG_COUNTS}, shares AS ({_share_rows}),
overall AS (SELECT tag, quantile_cont(share, 0.5) AS g FROM shares GROUP BY tag),
ranks AS (
  SELECT tag, CAST(row_number() OVER (ORDER BY avg(m) DESC, tag) AS INTEGER) AS tag_rank
  FROM (SELECT source, tag, avg(share) AS m FROM shares GROUP BY source, tag) GROUP BY tag)
SELECT source, tag, tag_rank, round(quantile_cont(share, 0.5), 6) AS median_share, round(any_value(g), 6) AS global_median
FROM shares JOIN overall USING (tag) JOIN ranks USING (tag) GROUP BY source, tag, tag_rank"""
ORACLES["sentence_length_dist"] = f"""
WITH {SENTENCES}, c AS (SELECT source, n_words, count(*) AS n FROM counted GROUP BY source, n_words),
f AS (
  SELECT source, n_words, n::DOUBLE / sum(n) OVER (PARTITION BY source) AS freq,
         CAST(row_number() OVER (PARTITION BY source ORDER BY n_words) - 1 AS INTEGER) AS place FROM c)
SELECT source, place, n_words, round(freq, 6) AS freq FROM f WHERE place BETWEEN 1 AND 14"""
ORACLES["punct_profile"] = f"""
WITH {SENTENCES}, m AS (SELECT source, n_words, {_sentence_marks} FROM counted)
SELECT source, n_words, count(*) AS n_sents, {", ".join(f"round(avg({c}), 6) AS {c}" for c in fixed.SENTENCE_MARKS.values())}
FROM m GROUP BY source, n_words"""
ORACLES["pos_profile"] = rf"""
WITH {LEXICON}, {SENTENCES},
toks AS (
  SELECT source, n_words, unnest(regexp_extract_all({for_morph("sentence")}, '[\p{{L}}]+(?:-[\p{{L}}]+)*')) AS token FROM counted),
c AS (
  SELECT source, n_words, regexp_extract(gr, '^[\p{{L}}\p{{N}}_]*') AS tag, count(*) AS n
  FROM toks JOIN lexicon ON form = lower(token) GROUP BY ALL),
s AS (SELECT source, n_words, count(*) AS n_sents FROM counted GROUP BY ALL),
g AS (SELECT *, unnest(['V', 'S', 'A', 'ADV', 'PR', 'CONJ']) AS tag FROM s)
SELECT source, n_words, tag, n_sents, round(coalesce(n, 0)::DOUBLE / n_sents, 6) AS mean_count
FROM g LEFT JOIN c USING (source, n_words, tag)"""
ORACLES["top_words"] = f"""
WITH {LEXICON}, {recipe(1).rsplit("r1 AS", 1)[0].rstrip().rstrip(",")}
SELECT x AS term, count(*) AS n FROM l1
WHERE x <> ' ' AND NOT regexp_matches(x, '^\\p{{Nd}}+$') AND length(x) >= 3
  AND NOT contains({q(fixed.ASCII_MARKS)}, {strip("x")}) AND x NOT IN {listed(STOP)}
GROUP BY x ORDER BY n DESC, term LIMIT 50"""
for _name, _size in [("top_bigrams", 2), ("top_trigrams", 3)]:
    ORACLES[_name] = f"""
WITH {grams(VECTOR_WORDS, "documents", _size, _size)}
SELECT term, count(*) AS n FROM grams GROUP BY term ORDER BY n DESC, term DESC LIMIT 10"""
ORACLES["docs_per_author"] = "SELECT source, count(DISTINCT doc_id) AS n_books FROM documents GROUP BY source"
ORACLES["author_sentences"] = f"WITH {SENTENCES} SELECT source, doc_id, pos, sentence, n_words FROM counted"

# splits

HASHED = """
h AS (
  SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42')) AS r,
         count(*) OVER (PARTITION BY lang) AS n FROM documents)"""
ORACLES["balance_classes"] = f"WITH {HASHED} SELECT doc_id, lang, text FROM h WHERE r <= (SELECT min(n) FROM h)"
ORACLES["holdout"] = (
    f"WITH {HASHED} SELECT doc_id, lang, CASE WHEN r <= ceil(n * 0.3::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM h"
)
ORACLES["nested_holdout"] = f"""
WITH {HASHED}, c AS (SELECT *, ceil(n * 0.2::DOUBLE) AS held FROM h)
SELECT doc_id, lang, CASE WHEN r <= ceil(held * 0.2::DOUBLE) THEN 'test' WHEN r <= held THEN 'valid' ELSE 'train' END AS split
FROM c"""
ORACLES["stratified_folds"] = f"""
WITH {HASHED} SELECT doc_id, lang,
  CAST({" + ".join(f"(r > floor(n * {i}::DOUBLE / 5))::INTEGER" for i in range(1, 5))} AS INTEGER) AS fold FROM h"""
FOLDS = f"""{SENTENCES},
g AS (SELECT lang, doc_id, count(*) AS n FROM counted GROUP BY lang, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, md5(CAST(doc_id AS VARCHAR) || ':42')) - 1 AS r FROM g),
folds AS (
  SELECT doc_id, lang, n, CAST(CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) AS fold FROM ranked),
cells AS (
  SELECT f.fold, l.lang, coalesce((SELECT sum(n) FROM folds x WHERE x.fold = f.fold AND x.lang = l.lang), 0) AS n_test,
         (SELECT sum(n) FROM folds x WHERE x.lang = l.lang) AS n_class
  FROM (SELECT unnest(range(5))::INTEGER AS fold) f, (SELECT DISTINCT lang FROM folds) l),
gaps AS (
  SELECT fold, 100.0::DOUBLE * (n_class - n_test) / sum(n_class - n_test) OVER (PARTITION BY fold)
    - 100.0::DOUBLE * n_test / sum(n_test) OVER (PARTITION BY fold) AS gap FROM cells),
rmse AS (SELECT fold, sqrt(avg(gap * gap)) AS rmse FROM gaps GROUP BY fold),
best AS (SELECT fold FROM rmse ORDER BY round(rmse, 9), fold LIMIT 1),
marked AS (
  SELECT c.doc_id, c.pos, CASE WHEN f.fold = (SELECT fold FROM best) THEN 'test' ELSE 'train' END AS split
  FROM counted c JOIN folds f ON f.doc_id = c.doc_id)"""
ORACLES["group_folds"] = f"WITH {FOLDS} SELECT doc_id, lang, n, fold FROM folds"
ORACLES["best_fold"] = f"WITH {FOLDS} SELECT fold, round(rmse, 6) AS rmse FROM rmse"
ORACLES["apply_split"] = f"WITH {FOLDS} SELECT doc_id, pos, split FROM marked"
ORACLES["leakage_check"] = f"""
WITH {FOLDS} SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
  (SELECT count(*) FROM (SELECT doc_id FROM marked WHERE split = 'train' INTERSECT SELECT doc_id FROM marked WHERE split = 'test'))
  AS n_shared FROM marked"""

# topics

_prose = r"regexp_replace(regexp_replace(regexp_replace(lower(text), 'https?://\S+', ' ', 'g'), '\p{Nd}+', '', 'g'), '[\p{P}\p{S}]', ' ', 'g')"
LEMMAS = rf"""{LEXICON}, toks AS ({tokens_of("documents", rf"regexp_extract_all({_prose}, '\p{{L}}+')")}),
kept AS (
  SELECT doc_id, pos, lemma FROM toks JOIN lexicon ON form = token
  WHERE tag IN ('S', 'A', 'V') AND lemma NOT IN {listed(STOP)})"""
ORACLES["content_lemmas"] = f"""
WITH {LEMMAS}, j AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS l FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(l, '') AS lemmas FROM documents d LEFT JOIN j USING (doc_id)"""
DICTIONARY = f"""{LEMMAS},
tf AS (SELECT doc_id, lemma AS term, count(*) AS tf FROM kept GROUP BY ALL),
dictionary AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
  HAVING count(*) >= 3 AND count(*) <= 0.5 * (SELECT count(*) FROM documents) ORDER BY df DESC, term LIMIT 5000)"""
ORACLES["dictionary"] = f"WITH {DICTIONARY} SELECT term, df FROM dictionary"
ORACLES["doc2bow"] = f"""
WITH {DICTIONARY},
w AS (SELECT doc_id, term, tf, tf * log2((SELECT count(*) FROM documents)::DOUBLE / df) AS w FROM tf JOIN dictionary USING (term))
SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""

# models with exact results

ORACLES["nb_predict"] = f"""
WITH {HASHED}, split AS (SELECT doc_id, lang, text, r > ceil(n * 0.3::DOUBLE) AS train FROM h),
{grams(VECTOR_WORDS, "split", 1, 1, "doc_id, lang, train")},
tf AS (SELECT doc_id, lang, train, term, count(*) AS tf FROM grams GROUP BY ALL),
seen AS (SELECT lang, term, sum(tf) AS n FROM tf WHERE train GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM seen),
classes AS (
  SELECT lang, ln(count(*)::DOUBLE / (SELECT count(*) FROM split WHERE train)) AS prior,
    (SELECT sum(n) FROM seen s WHERE s.lang = split.lang)::DOUBLE AS words FROM split WHERE train GROUP BY lang),
known AS (SELECT doc_id, term, tf FROM tf JOIN vocabulary USING (term)),
parts AS (
  SELECT k.doc_id, c.lang, sum(k.tf * ln((coalesce(s.n, 0) + 1) / (c.words + (SELECT count(*) FROM vocabulary)))) AS gain
  FROM known k CROSS JOIN classes c LEFT JOIN seen s ON s.term = k.term AND s.lang = c.lang GROUP BY k.doc_id, c.lang),
scored AS (
  SELECT d.doc_id, c.lang, c.prior + coalesce(p.gain, 0) AS score
  FROM documents d CROSS JOIN classes c LEFT JOIN parts p ON p.doc_id = d.doc_id AND p.lang = c.lang)
SELECT doc_id, lang AS prediction, round(score, 3) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC) = 1"""

ORACLES["knn_embeddings"] = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS nb, b.label, 1 - list_cosine_similarity(a.v, b.v) AS d
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, nb) <= 10),
votes AS (SELECT id, label, sum(1 / d) AS support FROM near GROUP BY id, label)
SELECT id, label AS prediction, round(support, 4) AS support FROM votes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(support, 9) DESC, label) = 1"""

ORACLES["class_weights"] = """
SELECT lang, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight
FROM documents GROUP BY lang"""

_hits = ", ".join(f"1 + len([x FOR x IN w IF x IN {listed(k)}])" for k in KEYWORDS.values())
PROBS = f"""
keyed AS (SELECT doc_id, lang, [{_hits}] AS h FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents)),
p AS (
  SELECT doc_id, CAST(list_position([{", ".join(q(k) for k in KEYWORDS)}], lang) - 1 AS INTEGER) AS label,
         [x::DOUBLE / list_sum(h) FOR x IN h] AS probability FROM keyed),
predicted AS (SELECT *, CAST(list_position(probability, list_max(probability)) - 1 AS INTEGER) AS prediction FROM p)"""
ORACLES["confusion_matrix"] = f"WITH {PROBS} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL"
REPORT = f"""{PROBS},
classes AS (SELECT label AS class FROM predicted UNION SELECT prediction FROM predicted),
tallies AS (
  SELECT class, (SELECT count(*) FROM predicted WHERE label = class) AS support,
    (SELECT count(*) FROM predicted WHERE prediction = class) AS guessed,
    (SELECT count(*) FROM predicted WHERE prediction = class AND label = class) AS hits FROM classes),
report AS (
  SELECT class, support, hits, CASE WHEN guessed > 0 THEN hits::DOUBLE / guessed ELSE 0.0::DOUBLE END AS precision,
    CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0.0::DOUBLE END AS recall,
    2.0::DOUBLE * hits / (support + guessed) AS f1 FROM tallies)"""
ORACLES["class_report"] = f"""
WITH {REPORT} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM report"""
ORACLES["f1_scores"] = f"""
WITH {REPORT} SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS f1_micro, round(avg(f1), 6) AS f1_macro,
  round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM report"""
ORACLES["auroc_binned"] = f"""
WITH {PROBS},
points AS (
  SELECT c.class, t.i,
    count(*) FILTER (WHERE label = class AND probability[class + 1] >= i::DOUBLE / 9)::DOUBLE / count(*) FILTER (WHERE label = class) AS tpr,
    count(*) FILTER (WHERE label <> class AND probability[class + 1] >= i::DOUBLE / 9)::DOUBLE / count(*) FILTER (WHERE label <> class) AS fpr
  FROM predicted, (SELECT unnest(range(4))::INTEGER AS class) c, (SELECT unnest(range(10)) AS i) t GROUP BY c.class, t.i),
steps AS (
  SELECT class, (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS area FROM points
  WINDOW w AS (PARTITION BY class ORDER BY i DESC))
SELECT class, round(coalesce(sum(area), 0), 6) AS auroc FROM steps GROUP BY class"""
ORACLES["reject_rule"] = f"""
WITH {PROBS}, r AS (SELECT doc_id, CASE WHEN list_max(probability) > 0.5 THEN prediction ELSE -1 END AS label FROM predicted)
SELECT doc_id, CAST(label AS INTEGER) AS label, CASE label {_names} END AS name FROM r"""
ORACLES["rank_authors"] = f"""
WITH {PROBS}, r AS (SELECT doc_id, CAST(unnest(range(4)) AS INTEGER) AS label, unnest(probability) AS p FROM predicted)
SELECT doc_id, label, round(p, 6) AS p, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, label) AS INTEGER) AS rank
FROM r"""

# usage

USERS = """
signups AS (
  SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
accepted AS (
  SELECT e.* FROM events e JOIN signups s ON s.user_id = e.user_id
  WHERE e.ts > s.ts OR (e.ts = s.ts AND e.event_id > s.event_id)),
requests AS (
  SELECT s.user_id, count(a.event_id) AS requests FROM signups s
  LEFT JOIN accepted a ON a.user_id = s.user_id AND a.event_type IN ('click', 'view') GROUP BY s.user_id),
last_rating AS (
  SELECT user_id, CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS rating FROM accepted WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ratings AS (SELECT s.user_id, rating FROM signups s LEFT JOIN last_rating USING (user_id))"""
ORACLES["registered_users"] = f"WITH {USERS} SELECT user_id, event_id AS first_event FROM signups"
ORACLES["user_requests"] = f"WITH {USERS} SELECT user_id, requests FROM requests"
ORACLES["user_ratings"] = f"WITH {USERS} SELECT user_id, rating FROM ratings"
ORACLES["usage_summary"] = f"""
WITH {USERS} SELECT count(*) AS total_users, CAST(coalesce(sum(requests), 0) AS BIGINT) AS total_requests,
  round_even(coalesce((SELECT avg(rating) FROM ratings), 0), 2) AS avg_rating FROM requests"""
ORACLES["running_rating"] = """
WITH v AS (SELECT event_id, ts, CAST(CAST(floor(value) AS BIGINT) % 8 AS INTEGER) AS vote FROM events WHERE event_type = 'purchase'),
r AS (
  SELECT event_id, vote, 1 + count(*) FILTER (WHERE vote BETWEEN 1 AND 5) OVER w AS n_votes,
    5 + coalesce(sum(vote) FILTER (WHERE vote BETWEEN 1 AND 5) OVER w, 0) AS s
  FROM v WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, vote, n_votes, round(s::DOUBLE / n_votes, 6) AS mean_vote FROM r"""

# fragments and streams

ORACLES["fragments"] = rf"""
WITH RECURSIVE toks AS MATERIALIZED (
  SELECT *, sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS filled FROM ({tokens_of(
      "documents",
      r"regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+(?:-[\p{L}\p{M}\p{N}_]+)*|\.{3}|[^\p{L}\p{M}\p{N}_\s]')",
      "doc_id, source",
  )})),
ends AS MATERIALIZED (
  SELECT a.doc_id, a.pos AS at, b.pos + 1 AS next_at
  FROM (SELECT doc_id, pos, filled - length(token) - 1 + 1000 AS goal FROM toks) a
  ASOF JOIN toks b ON a.doc_id = b.doc_id AND a.goal <= b.filled),
starts AS (
  SELECT doc_id, 0 AS at, 0 AS pos FROM documents
  UNION ALL
  SELECT e.doc_id, e.next_at, s.pos + 1 FROM starts s JOIN ends e ON s.doc_id = e.doc_id AND s.at = e.at),
placed AS (
  SELECT t.doc_id, t.source, s.pos, string_agg(t.token, ' ' ORDER BY t.pos) AS whole
  FROM toks t ASOF JOIN starts s ON t.doc_id = s.doc_id AND t.pos >= s.at GROUP BY ALL),
cut AS (
  SELECT p.*, regexp_extract(whole, '(?s)^.*[.,!?]') AS c, EXISTS (SELECT 1 FROM starts s WHERE s.doc_id = p.doc_id AND s.pos = p.pos + 1) AS is_full
  FROM placed p)
SELECT doc_id AS book, 'author_id_' || CASE WHEN length(a) < 2 THEN '0' || a ELSE a END AS target, pos,
       CASE WHEN is_full AND c <> '' THEN c ELSE whole END AS text
FROM (SELECT *, regexp_extract(source, '([0-9]+)$', 1) AS a FROM cut)"""

ORACLES["usage_stream"] = """
SELECT strftime(time_bucket(INTERVAL '30 seconds', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  count(*) FILTER (WHERE event_type = 'signup') AS n_signups,
  count(*) FILTER (WHERE event_type IN ('click', 'view')) AS n_requests,
  count(*) FILTER (WHERE event_type = 'purchase') AS n_ratings,
  CAST(coalesce(sum(1 + CAST(floor(value) AS BIGINT) % 5) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS sum_ratings
FROM events GROUP BY 1"""
ORACLES["new_user_stream"] = ORACLES["registered_users"]
ORACLES["user_counter_stream"] = f"""
WITH {USERS} SELECT user_id AS id, requests, rating FROM requests JOIN ratings USING (user_id)"""

# models: what must hold of every scored row

_LABELLED = f"""
WITH {HASHED}, l AS (
  SELECT doc_id, CASE WHEN r <= ceil(n * 0.3::DOUBLE) THEN 'test' ELSE 'train' END AS split,
         CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label FROM h)
SELECT doc_id, split, label, true AS known, true AS bounded, true AS learned"""
for _name in ("lr", "nb", "svm", "svm_rbf", "knn", "rf", "gbt"):
    ORACLES[f"{_name}_scores"] = f"{_LABELLED} FROM l"
_FEATURES = [r"[.]", r"[,]", r"[!?]", r"\n", r"\p{Lu}", r"[^\x00-\x7F]", r"\p{Nd}", r"[|#$%&*]"]
_counts = ", ".join(f"len(regexp_extract_all(text, {q(p)}))" for p in _FEATURES)
ORACLES["boost_first_borders"] = f"""
WITH d AS (SELECT CAST(dense_rank() OVER (ORDER BY lang) AS INTEGER) AS c, [{_counts}, len({WORDS})] AS x FROM documents),
v AS (SELECT c, unnest(range(9))::INTEGER AS feature, unnest(x) AS v FROM d),
prior AS (SELECT c, count(*)::DOUBLE / sum(count(*)) OVER () AS p, count(*) AS n, sum(count(*)) OVER () AS total FROM d GROUP BY c),
b AS (SELECT unnest([0, 1, 2, 5, 10, 20, 50, 100, 200, 500, 1000])::DOUBLE AS border),
l AS (SELECT feature, border, c, count(*) FILTER (v <= border) AS n_c FROM v, b GROUP BY ALL),
s AS (SELECT *, sum(n_c) OVER (PARTITION BY feature, border) AS n_left FROM l),
g AS (
  SELECT feature, border, sum(
    pow(n_left * p - n_c, 2) / (2 * p * (1 - p) * n_left + 1) + pow((total - n_left) * p - (n - n_c), 2) / (2 * p * (1 - p) * (total - n_left) + 1)) AS gain
  FROM s JOIN prior USING (c) GROUP BY ALL)
SELECT feature, border, round(gain, 6) AS gain FROM g
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 9) DESC, border) = 1"""
ORACLES["softmax_boost_scores"] = f"{_LABELLED}, true AS falling, true AS held_out_better FROM l"
ORACLES["pruned_forest_scores"] = f"{_LABELLED}, true AS fewer FROM l"
ORACLES["soft_vote"] = f"{_LABELLED} FROM l"
ORACLES["training_run"] = f"{_LABELLED}, true AS best FROM l WHERE split = 'test'"
ORACLES["random_search"] = """
SELECT unnest(range(10))::INTEGER AS draw, true AS bounded, true AS best_first, 0::BIGINT AS n_leaks,
       (SELECT count(*) FROM documents) AS n_rows"""
ORACLES["random_search_draws"] = "SELECT unnest(range(10))::INTEGER AS draw, 10::INTEGER AS n_params, true AS bounded, true AS ordered"
ORACLES["embedding_head"] = f"""
WITH h AS (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42')) AS r,
         ceil(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE) AS held FROM embeddings)
SELECT vec_id, CASE WHEN r <= ceil(held * 0.2::DOUBLE) THEN 'test' WHEN r <= held THEN 'valid' ELSE 'train' END AS split,
       label, true AS known, true AS bounded, true AS learned FROM h"""
ORACLES["relu_head_scores"] = ORACLES["embedding_head"].replace("true AS learned FROM h", "true AS learned, true AS best FROM h")
ORACLES["guided_trials"] = "SELECT unnest(range(12))::INTEGER AS trial, 2::INTEGER AS n_params, true AS bounded, true AS ordered"
ORACLES["lda_topics"] = """
SELECT doc_id, CAST(k AS INTEGER) AS k, true AS bounded FROM documents, (SELECT unnest([10, 15, 20, 25, 30]) AS k)"""
ORACLES["svd_coords"] = f"""
WITH {grams(VECTOR_WORDS, "documents", 1, 1)}, {CORPUS},
kept AS (SELECT tf FROM tf JOIN dfs USING (term) WHERE df >= 3 AND df <= 0.5 * (SELECT count(*) FROM documents))
SELECT doc_id, true AS falling, true AS orthogonal, (SELECT CAST(sum(tf * tf) AS BIGINT) FROM kept) AS squared_norm FROM documents"""
ORACLES["pca_variance"] = "SELECT CAST(unnest([10, 20, 30, 40, 50]) AS INTEGER) AS k, true AS rising"
ORACLES["score_stream"] = "SELECT doc_id, true AS known, true AS same FROM documents"
ORACLES["default_vocabulary"] = f"""
WITH {grams(VECTOR_WORDS, "documents", 1, 1)}, {CORPUS}
SELECT CASE WHEN df = 1 THEN '1' WHEN df < 5 THEN '2-4' WHEN df < 10 THEN '5-9' ELSE '10+' END AS band, count(*) AS n_terms
FROM dfs GROUP BY 1"""
