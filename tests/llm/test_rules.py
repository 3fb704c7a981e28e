import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from penprint.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


TEXTS = [None, "", "\n", "\n\na\n\na\n", "a b c a b c", "x " * 9, "é ß\x0b日本 |<>", "a\r\na\r\n a\r\n", "one\ntwo\none", "a b\na b\n\tA b", "w " * 70000 + "end"]


def got(texts):
    counts = rules.statistics(pa.array(texts, pa.string()))
    return list(zip(*(counts[c].tolist() for c in rules.COUNTS)))


def test_counts_of_texts():
    assert got(TEXTS) == [plain(t) for t in TEXTS]
    assert got(TEXTS[3:8]) == [plain(t) for t in TEXTS[3:8]] and got([]) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é|\n\t\x0c", max_size=40)), max_size=6))
def test_counts_of_any_texts(texts):
    assert got(texts) == [plain(t) for t in texts]


def test_codes_beyond_63_bits_are_numbered_anew():
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 1 << 40, 400) // (1 << 37), rng.integers(0, 1 << 40, 400) // (1 << 38), rng.integers(0, 3, 400) << 38
    code = rules.paired(rules.paired(a << 38, b << 38), c)
    assert len(set(code.tolist())) == len(set(zip(a.tolist(), b.tolist(), c.tolist())))


def test_buckets_and_their_middles(spark):
    values = [*range(0, 300), *[(1 << k) + d for k in range(9, 60) for d in (-1, 0, 1)]]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", rules.bucket(F.col("v")).alias("b"))
    rows = rows.select("v", "b", rules.middle(F.col("b")).alias("m")).collect()
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    assert all(abs(r["v"] - r["m"]) * 32 <= r["v"] for r in rows) and all(r["m"] == r["v"] for r in rows if r["v"] < 64)


def test_merged_sketches_equal_one_sketch(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * F.col("id") % 9973).alias("v"), (F.col("id") % 2).alias("half"))
    whole = rules.sketched(rows, ["k"], {"v": F.col("v")})
    halves = [rules.sketched(rows.where(f"half = {h}"), ["k"], {"v": F.col("v")}) for h in (0, 1)]
    key = lambda df: sorted(map(tuple, df.select("k", "rule", "bucket", "n").collect()))
    assert key(rules.merged(halves, ["k"])) == key(whole)
    values = {k: sorted(r["v"] for r in rows.where(f"k = {k}").collect()) for k in range(3)}
    for q in rules.quartiles(whole, ["k"]).collect():
        own = values[q["k"]]
        assert q["seen"] == len(own)
        for name, p in (("low", 1), ("high", 3)):
            want = own[(len(own) - 1) * p // 4]
            assert abs(q[name] - want) * 32 <= want


@pytest.fixture(scope="module")
def mixed(spark):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(80)), lambda i: F.substring(F.md5((F.col("id") * 1000 + i).cast("string")), 1, 5)))
    odd = F.when(F.col("id") % 40 == 7, F.regexp_replace(words, " ", "%%% ")).when(F.col("id") % 40 == 8, F.regexp_replace(words, " ", "")).when(
        F.col("id") % 40 == 9, F.lit("same words here " * 30)).otherwise(words)
    return spark.range(900).select(
        F.col("id").alias("doc_id"), odd.alias("text"), F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % 3 == 1, "de").alias("lang"),
        F.when(F.col("id") < 700, "hot").when(F.col("id") < 880, "warm").alias("source"), F.lit(1).alias("rule_n_words"), F.lit("x").alias("n"))


def test_odd_documents_go_and_plain_ones_stay(spark, mixed):
    out = rules.ruled(mixed)
    assert "n" in out.columns and out.columns.count("rule_n_words") == 1
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == 900
    assert all(r["rule_kept"] == (k % 40 not in (7, 8, 9)) for k, r in rows.items())
    again = {r["doc_id"]: r["rule_kept"] for r in rules.ruled(mixed.repartition(7)).collect()}
    assert again == {k: r["rule_kept"] for k, r in rows.items()}
    assert rules.ruled(mixed.limit(0)).count() == 0


def test_null_groups_repeated_rows_and_small_groups(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good, None, None), (1, good, None, None), (None, good, "en", "s"), (3, None, None, "s"), (4, "", "en", None), (5, good + " #" * 60, "en", "s")]
    out = rules.ruled(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()
    assert sorted((r["doc_id"] or 0, r["rule_kept"]) for r in out) == [(0, True), (1, True), (1, True), (3, False), (4, False), (5, False)]
    levels = rules.fences(rules.sketched(spark.createDataFrame([("=a", "=x", 5)] * 3 + [("=a", "=y", 7)] * 2 + [("=b", "=x", 9)], "lang string, source string, v bigint"), ["lang", "source"], {"symbols": F.col("v")}), 3)
    assert {(r["lang"], r["source"]): r["level"] for r in levels.collect()} == {("=a", "=x"): 2, ("=a", "=y"): 1, ("=b", "=x"): 0}


def test_query_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(con.execute(rules.SQL).fetchall())
    assert sorted(map(tuple, rules.op12_rules(spark, small).collect())) == want
    assert {r[-1] for r in want} == {True, False}
