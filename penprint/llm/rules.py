"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

A sketch counts whole numbers in buckets that double in width with every octave (32 to an octave), so a quantile is off
by a 32nd at most, sketches are merged by adding their counts, and no order of merging changes one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from penprint.llm.common import bounded, written
from penprint.llm.words import SPACES, flat, spans
from penprint.operators.scale import lookup_join

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Rule, numerator, denominator, and the least distance of a fence from its quartile; all in thousandths.
RULES = (
    ("word_length", "word_chars", "n_words", 1500),
    ("symbols", "n_symbols", "n_words", 100),
    ("dup_lines", "n_dup_lines", "n_lines", 600),
    ("repeats", "n_repeat_words", "n_words", 300),
)
FENCE = 3  # quartile distances between a quartile and its fence
ENOUGH = 100  # documents of a group with a fence of its own
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers; the left ones are numbered anew if the product leaves 63 bits."""
    if not len(a):
        return a
    most = int(b.max()) + 1
    if (int(a.max()) + 1) * most >= 1 << 62:
        a = np.unique(a, return_inverse=True)[1]
    return a * most + b


def codes_of(data: np.ndarray, inside: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal spans; ``inside`` marks the bytes of all spans."""
    offsets = np.append(0, np.cumsum(ends - begins)).astype(np.int64)
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return np.asarray(values.dictionary_encode().indices, np.int64)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column."""
    data, bounds = flat(texts)
    n = len(bounds) - 1

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(marks))[bounds])

    solid = ~SPACES[data]
    begins, ends, rows = spans(data, bounds)
    doc = np.repeat(np.arange(n), np.diff(rows))
    out = {
        "n_words": np.diff(rows),
        "word_chars": per_text(solid & (data & 0xC0 != 0x80)),
        "n_symbols": per_text(SYMBOLS[data]),
    }
    new = data == 0x0A
    line_ends = np.sort(np.append(np.flatnonzero(new), bounds[1:]), kind="stable")
    before = np.searchsorted(np.flatnonzero(new), bounds)
    line_doc = np.repeat(np.arange(n), np.diff(before) + 1)
    first = np.append(True, np.diff(line_doc) > 0) if n else np.zeros(0, bool)
    line_begins = np.where(first, bounds[:-1][line_doc], np.append(0, line_ends[:-1] + 1))
    filled = np.append(0, np.cumsum(solid))
    filled = filled[line_ends] > filled[line_begins]
    line = paired(line_doc, codes_of(data, ~new, line_begins, line_ends))[filled]
    line, at = np.unique(line, return_index=True)
    out["n_lines"] = np.bincount(line_doc[filled], minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[filled][at], minlength=n)
    word = codes_of(data, solid, begins, ends)
    start = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) > 2 else np.zeros(0, np.int64)
    window = paired(paired(paired(doc[start], word[start]), word[start + 1]), word[start + 2])
    _, place, found = np.unique(window, return_inverse=True, return_counts=True)
    again = start[found[place] > 1]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 3, -1)
    covered = np.append(0, np.cumsum(np.cumsum(cover[:-1]) > 0))
    out["n_repeat_words"] = np.diff(covered[rows])
    return out


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of every whole text as columns ``rule_n_words`` and so on; a null text counts as empty.

    word_chars are code points in words, n_symbols the characters ``#*$%&|<>``, n_lines the lines with a word,
    n_dup_lines those of them equal to an earlier line, n_repeat_words the words in a window of three words that the
    text has twice or more. Other columns pass unchanged.
    """
    names = [f"rule_{c}" for c in COUNTS]
    docs = docs.drop(*names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, column=text):
            counts = statistics(batch.column(text))
            columns = [*batch.columns, *[pa.array(counts[c], pa.int64()) for c in COUNTS]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return docs.mapInArrow(run, ST.StructType([*docs.schema.fields, *[ST.StructField(n, ST.LongType()) for n in names]]))


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0 up: itself below 64, then 32 to an octave."""
    shift = F.length(F.bin(value)) - 6
    wide = shift * 32 + F.call_function("shiftright", value, shift)
    return F.when(value < 64, value).otherwise(wide).cast("bigint")


def middle(place: Column) -> Column:
    """The number in the middle of a bucket."""
    shift = F.floor(place / 32).cast("int") - 1
    wide = F.call_function("shiftleft", place - shift * 32, shift) + F.call_function("shiftright", F.call_function("shiftleft", F.lit(1).cast("bigint"), shift), F.lit(1))
    return F.when(place < 64, place).otherwise(wide).cast("bigint")


def sketched(rows: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Sketches of several numbers per group: keys, rule, bucket, n. Null numbers have no part in them."""
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), bucket(value).alias("bucket")) for name, value in values.items()])
    rows = rows.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.rule", "p.bucket").where(F.col("bucket").isNotNull())
    return rows.groupBy(*keys, "rule", "bucket").agg(F.count("*").alias("n"))


def merged(sketches: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The sketch of all that the given ones saw, per ``keys`` (some or all of theirs)."""
    first, *more = [s.select(*keys, "rule", "bucket", "n") for s in sketches]
    for sketch in more:
        first = first.unionByName(sketch)
    return first.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lower and upper quartile per group and rule: keys, rule, seen, low, high.

    A group has at most 32 buckets to an octave, some 2,000 in all, whatever it has seen.
    """
    group = ", ".join([*keys, "rule"])
    walked = sketch.selectExpr(
        *keys, "rule", "bucket",
        f"sum(n) OVER (PARTITION BY {group} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto",
        f"sum(n) OVER (PARTITION BY {group}) AS seen",
    )
    at = [F.min(F.when(F.col("upto") > F.expr(f"((seen - 1) * {k}) div 4"), F.col("bucket"))) for k in (1, 3)]
    return walked.groupBy(*keys, "rule", "seen").agg(middle(at[0]).alias("low"), middle(at[1]).alias("high"))


def shares() -> dict[str, Column]:
    """What the rules look at, in thousandths; null where the denominator is 0."""
    return {
        rule: F.expr(f"CASE WHEN rule_{below} > 0 THEN (rule_{above} * 1000) div rule_{below} END")
        for rule, above, below, _ in RULES
    }


def base_failed() -> Column:
    few = F.col("rule_n_words") < LEAST_WORDS
    return few | (F.col("rule_n_repeat_words") * 100 > F.col("rule_n_words") * MOST_REPEATED)


def fences(sketch: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """Bounds of every rule for every group of a sketch keyed by lang and source: lang, source, rule, least, most, level.

    Bounds lie ``FENCE`` quartile distances, or the rule's own least distance if that is more, outside the quartiles.
    Groups that saw fewer than ``enough`` documents use the merged sketch of their language, and if that saw too few,
    of everything; ``level`` says which (2, 1, 0).
    """
    own = quartiles(sketch, ["lang", "source"])
    of_lang = quartiles(merged([sketch], ["lang"]), ["lang"])
    of_all = quartiles(merged([sketch], []), [])
    renamed = [q.select(*keys, "rule", F.struct("seen", "low", "high").alias(name)) for q, keys, name in ((own, ["lang", "source"], "_own"), (of_lang, ["lang"], "_lang"), (of_all, [], "_all"))]
    joined = lookup_join(lookup_join(renamed[0], renamed[1], ["lang", "rule"]), renamed[2], ["rule"])
    use = F.when(F.col("_own.seen") >= enough, F.struct(F.lit(2).alias("level"), "_own"))
    use = use.when(F.col("_lang.seen") >= enough, F.struct(F.lit(1).alias("level"), F.col("_lang").alias("_own")))
    use = use.otherwise(F.struct(F.lit(0).alias("level"), F.col("_all").alias("_own")))
    chosen = joined.select("lang", "source", "rule", use.alias("u")).select("lang", "source", "rule", "u.level", "u._own.low", "u._own.high")
    slack = F.create_map(*[F.lit(x) for rule, _, _, least in RULES for x in (rule, least)])[F.col("rule")]
    reach = F.greatest((F.col("high") - F.col("low")) * FENCE, slack)
    return chosen.select("lang", "source", "rule", (F.col("low") - reach).alias("least"), (F.col("high") + reach).alias("most"), "level")


def ruled(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", enough: int = ENOUGH) -> DataFrame:
    """Every row of ``docs`` with its counts and verdict.

    Adds rule_<count>, rule_base_failed (fewer than 50 words, or over half of them repeated) and rule_kept: no rule of
    its language and source is broken and the base did not fail. Thresholds are learned from the rows that pass the base;
    a null language or source is a group of its own; null and empty texts have no words and fail the base; repeated rows
    count as often as they occur and get equal verdicts; a group of which no row passes the base has no thresholds, and
    needs none. Columns of ``docs`` pass unchanged, but those whose names begin with rule_ or _rule_ are left out.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith(("rule_", "_rule_"))])
    keyed = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in (lang, source)]
    rows = measured(docs, text).withColumn("rule_base_failed", base_failed())
    light = rows.where(~F.col("rule_base_failed")).withColumns({"_rule_lang": keyed[0], "_rule_source": keyed[1]})
    light = light.select(F.col("_rule_lang").alias("lang"), F.col("_rule_source").alias("source"), *[f"rule_{c}" for c in COUNTS])
    sketch = written(sketched(light, ["lang", "source"], shares()), "sketches")
    bounds = fences(sketch, enough).groupBy("lang", "source").pivot("rule", [r[0] for r in RULES]).agg(F.first(F.struct("least", "most")))
    bounds = written(bounds.select(F.col("lang").alias("_rule_lang"), F.col("source").alias("_rule_source"), *[F.col(r[0]).alias(f"_rule_{r[0]}") for r in RULES]), "fences")
    salts = ["rule_word_chars", "rule_n_words", "rule_n_symbols"]
    joined = lookup_join(rows.withColumns({"_rule_lang": keyed[0], "_rule_source": keyed[1]}), bounds, ["_rule_lang", "_rule_source"], "left", salt_on=salts)
    within = ~F.col("rule_base_failed")
    for rule, value in shares().items():
        within = within & F.coalesce(value.between(F.col(f"_rule_{rule}.least"), F.col(f"_rule_{rule}.most")), F.lit(True))
    return joined.withColumn("rule_kept", within).drop("_rule_lang", "_rule_source", *[f"_rule_{r[0]}" for r in RULES])


def op12_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return ruled(docs).select("doc_id", *[F.col(f"rule_{c}").alias(c) for c in names])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, 'null') AS lang, coalesce('=' || source, 'null') AS source,
         coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (SELECT row, i, array_to_string(w[i : i + 2], ' ') AS words FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
again AS (SELECT row, i FROM win QUALIFY count(*) OVER (PARTITION BY row, words) > 1),
rep AS (SELECT row, count(DISTINCT i + k)::BIGINT AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
m AS (
  SELECT d.row, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d) d
  LEFT JOIN rep ON rep.row = d.row
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [word_chars * 1000 // nullif(n_words, 0), n_symbols * 1000 // nullif(n_words, 0),
          n_dup_lines * 1000 // nullif(n_lines, 0), n_repeat_words * 1000 // nullif(n_words, 0)] AS value
  FROM m
), s AS (
  SELECT lang, source, rule, bucket, count(*) AS n FROM (
    SELECT lang, source, rule, CASE WHEN x < 64 THEN x ELSE (length(bin(x)) - 6) * 32 + (x >> (length(bin(x)) - 6)) END AS bucket
    FROM (SELECT lang, source, unnest([1, 2, 3, 4]) AS rule, unnest(value) AS x FROM v WHERE NOT base_failed)
  ) WHERE bucket IS NOT NULL GROUP BY ALL
), a AS (
  SELECT 2 AS level, lang, source, rule, bucket, n FROM s
  UNION ALL SELECT 1, lang, NULL, rule, bucket, sum(n) FROM s GROUP BY lang, rule, bucket
  UNION ALL SELECT 0, NULL, NULL, rule, bucket, sum(n) FROM s GROUP BY rule, bucket
), c AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket ROWS UNBOUNDED PRECEDING)::BIGINT AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, rule)::BIGINT AS seen
  FROM a
), q AS (
  SELECT level, lang, source, rule, seen, min(bucket) FILTER (upto > (seen - 1) // 4)::BIGINT AS b1, min(bucket) FILTER (upto > (seen - 1) * 3 // 4)::BIGINT AS b3
  FROM c GROUP BY ALL
), l AS (
  SELECT level, lang, source, rule, seen,
         CASE WHEN b1 < 64 THEN b1 ELSE ((b1 - (b1 // 32 - 1) * 32) << (b1 // 32 - 1)) + ((1::BIGINT << (b1 // 32 - 1)) >> 1) END AS low,
         CASE WHEN b3 < 64 THEN b3 ELSE ((b3 - (b3 // 32 - 1) * 32) << (b3 // 32 - 1)) + ((1::BIGINT << (b3 // 32 - 1)) >> 1) END AS high
  FROM q
), f AS (
  SELECT o.lang, o.source, o.rule,
         CASE WHEN o.seen >= 100 THEN o.low WHEN g.seen >= 100 THEN g.low ELSE t.low END AS low,
         CASE WHEN o.seen >= 100 THEN o.high WHEN g.seen >= 100 THEN g.high ELSE t.high END AS high
  FROM (SELECT * FROM l WHERE level = 2) o
  JOIN (SELECT * FROM l WHERE level = 1) g ON g.lang = o.lang AND g.rule = o.rule
  JOIN (SELECT * FROM l WHERE level = 0) t ON t.rule = o.rule
), e AS (
  SELECT v.row, bool_or(x < low - greatest(3 * (high - low), [1500, 100, 600, 300][f.rule]) OR x > high + greatest(3 * (high - low), [1500, 100, 600, 300][f.rule])) AS broken
  FROM (SELECT row, lang, source, unnest([1, 2, 3, 4]) AS rule, unnest(value) AS x FROM v WHERE NOT base_failed) v
  JOIN f ON f.lang = v.lang AND f.source = v.source AND f.rule = v.rule GROUP BY v.row
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(broken, false) AS kept
FROM v LEFT JOIN e ON e.row = v.row
"""
