import duckdb
import pytest
from pyspark.sql import functions as F

from penprint.llm import mixing


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing and resharing until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 1000, "c": 30, None: 5}, {"b": 0, "a": 7}, {"x": 0}, {"é": 3, "z": 900, "Z": 1, "a": 50, "b": 2}, {None: 4}],
)
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, "a b  c", "s", 7, "w"), (1, "a b  c", "s", 7, "w"), (2, None, None, 8, "v"), (None, "", "t", 9, None), (3, "x " * 50000, "s", 0, "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, rate int, weight string")
    plan = mixing.planned(docs).collect()
    assert len(plan) == 5 and {r["rate"] for r in plan} == {7, 8, 9, 0}
    assert {r["doc_id"]: r["mix_size"] for r in plan} == {1: 3, 2: 0, None: 0, 3: 50000}
    assert len({r["mix_copies"] for r in plan if r["doc_id"] == 1}) == 1
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["mix_copies"] for r in plan)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_taken_words_come_near_the_targets_and_repeat(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
        F.repeat(F.lit("word "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
    )
    plan = mixing.planned(docs)
    rows = plan.groupBy("source", "mix_target", "mix_source_size").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("t"), F.max("mix_copies").alias("c"))
    rows = rows.collect()
    assert all(abs(r["t"] - r["mix_target"]) < 0.15 * r["mix_target"] + 50 and r["c"] <= 3 for r in rows)
    assert abs(sum(r["mix_target"] for r in rows) - sum(r["mix_source_size"] for r in rows)) < 1e-3
    first = sorted(map(tuple, plan.select("doc_id", "mix_copies").collect()))
    again = sorted(map(tuple, mixing.planned(docs.repartition(3)).select("doc_id", "mix_copies").collect()))
    assert first == again


def test_query_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall())
    assert sorted(map(tuple, mixing.op4_mix(spark, small).collect())) == want
