import numpy as np
from pyspark.sql import functions as F

from penprint.operators import scale


def skewed(spark, n=3000):
    """A third of the rows under one key, and one value very common."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    value = F.when(F.col("id") % 4 == 0, F.lit(0.0)).otherwise(F.rand(3) * 100 - 50)
    return spark.range(n).select("id", hot.alias("key"), value.alias("x"), (F.col("id") % 11).cast("int").alias("y"))


def test_exact_quantiles(spark):
    df = skewed(spark).cache()
    pdf = df.toPandas()
    for prob in (0.0, 0.5, 0.99, 1.0):
        for width in (1e6, 1.0, 0.01):
            rows = scale.exact_quantiles(df, ["key"], ["x", "y"], prob, width).collect()
            got = {(r["key"], r["stat"]): r["value"] for r in rows}
            for key, part in pdf.groupby("key"):
                for c in ("x", "y"):
                    assert np.isclose(got[(key, c)], np.quantile(part[c], prob)), (key, c, prob, width)


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), ("b", None)], "key string, x double")
    assert [(r["key"], r["value"]) for r in scale.exact_quantiles(df, ["key"], ["x"]).collect()] == [("a", 2.5)]


def test_hash_cutoffs(spark):
    df = skewed(spark).withColumn("h", scale.hash_order("id"))
    wanted = F.array(F.lit(1), F.col("n_min"), F.col("n"))
    cuts = {(r["key"], r["slot"]): r["cutoff"] for r in scale.hash_cutoffs(df, ["key"], "h", wanted).collect()}
    pdf = df.toPandas()
    smallest = pdf.groupby("key").size().min()
    for key, part in pdf.groupby("key"):
        ordered = sorted(part["h"])
        assert [cuts[(key, i)] for i in range(3)] == [ordered[0], ordered[smallest - 1], ordered[-1]]


def test_size_then_hash_rank(spark):
    df = skewed(spark).withColumn("h", scale.hash_order("id"))
    ranked = scale.size_then_hash_rank(df, ["key"], "y", "h").toPandas()
    for _, part in ranked.groupby("key"):
        ordered = part.sort_values(["y", "h"], ascending=[False, True])
        assert ordered["rank"].tolist() == list(range(1, len(part) + 1))


def test_running_totals_and_ids(spark):
    df = skewed(spark)
    pdf = scale.running_totals(df, ["y", "id"], {"s": F.col("y"), "n": F.lit(1)}).toPandas().sort_values(["y", "id"])
    assert pdf["s"].tolist() == pdf["y"].cumsum().tolist()
    assert pdf["n"].tolist() == list(range(1, len(pdf) + 1))
    ids = scale.dense_ids(df.select("id"), ["id"], "number").toPandas()
    assert (ids["id"] == ids["number"]).all()


def test_balanced_and_unnest(spark):
    one = spark.range(100, numPartitions=1)
    assert scale.balanced(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=64)
    assert scale.balanced(many) is many
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, l array<string>")
    rows = scale.unnest(df, ["id"], F.col("l"), "v", "p").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 1, "b")]


def test_tokenisers_run_once(spark, small):
    """The tokeniser must not be evaluated again as a size test below the shuffle."""
    from penprint.operators import terms
    from penprint.sources.tables import read_table

    plan = terms.term_counts(read_table(spark, small, "documents"), "doc_id", terms.vector_tokens("text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_extract_all") == 1
    assert text.count("Exchange") == 1


def test_word_join_of_a_large_table(spark, monkeypatch):
    """Frequent words are looked up in place, rare ones by a join; nulls, unknown and repeated words keep their rows."""
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(scale, "FREQUENT_ROWS", 3)
    words = ["a"] * 40 + ["b"] * 20 + ["gone"] * 30 + [f"w{i}" for i in range(20)] + [None, "lost"]
    big = spark.createDataFrame([(i % 7, w) for i, w in enumerate(words)], "doc int, form string").repartition("doc")
    table = spark.createDataFrame([(w, w.upper()) for w in sorted({w for w in words if w} - {"gone", "lost"})], "form string, up string")
    assert {r["form"] for r in scale.frequent_keys(big, "form").collect()} == {"a", "b", "gone"}
    joined = scale.word_join(big, table, "form", by=["doc"])
    key = lambda r: (r["doc"], r["form"] or "", r["up"] or "")
    assert sorted(joined.collect(), key=key) == sorted(big.join(table, "form", "left").collect(), key=key)
    counts = {r["doc"]: r["count"] for r in joined.groupBy("doc").count().collect()}
    assert counts == {r["doc"]: r["count"] for r in big.groupBy("doc").count().collect()}


def test_lexicon_lookups_of_a_large_table_are_not_salted(spark, monkeypatch):
    from penprint.operators.lexicon import with_lexicon

    monkeypatch.setattr(scale, "BROADCAST_ROWS", 2)
    rows = spark.createDataFrame([(1, w) for w in "x x x y z".split()], "doc int, token string")
    lexicon = spark.createDataFrame([(w, w + w) for w in "xyzu"], "form string, lemma string")
    out = with_lexicon(rows, lexicon, ["lemma"])
    assert "_salt" not in out._jdf.queryExecution().toString()
    assert sorted(r["lemma"] for r in out.collect()) == ["xx", "xx", "xx", "yy", "zz"]
