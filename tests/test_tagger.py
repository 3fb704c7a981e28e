import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from penprint.operators import scale, tagger


@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        tags, forms = [], []
        for _ in range(rng.randrange(7)):
            tags.append(rng.choice({"D": "NA", "N": "VVN", "A": "NNA", "V": "DDA", "": "DDN"}[tags[-1] if tags else ""]))
            forms.append(rng.choice({"D": ["the", "a"], "N": ["can", "man", "rest", f"n{k}"], "V": ["can", "rest", "saw"], "A": ["old", "rest"]}[tags[-1]]))
        rows.append((k // 7, k % 7, forms, tags))
    return rows, spark.createDataFrame(rows, "doc int, pos int, forms array<string>, tags array<string>")


def test_costs_equal_plain_counts(spark, taught):
    rows, table = taught
    model = tagger.learn(table)
    assert model.tags == ["A", "D", "N", "V"]
    moves, words, total, seen = Counter(), Counter(), Counter(), Counter()
    for _, _, forms, tags in rows:
        moves.update(zip([".", *tags], [*tags, "."]) if tags else [])
        words.update(zip(forms, tags))
        total.update(tags)
        seen.update(forms)
    names = [*model.tags, "."]
    for i, a in enumerate(names):
        whole = sum(moves[a, b] for b in names)
        for j, b in enumerate(names):
            assert abs(model.steps[i, j] + math.log((moves[a, b] + 1) / (whole + 5)) * 1e6) < 1
    for r in model.forms.collect():
        for tag, c in zip(model.tags, r["costs"]):
            n = words[r["form"], tag]
            assert (c is None) == (n == 0) and (not n or abs(c + math.log(n / total[tag]) * 1e6) < 1)
    once = Counter(t for (f, t), n in words.items() if seen[f] == 1)
    assert all(abs(c + math.log((once[t] + 1) / (total[t] + 4)) * 1e6) < 1 for t, c in zip(model.tags, model.unseen))


def test_best_paths_equal_trying_all():
    rng = np.random.default_rng(7)
    for _ in range(20):
        n = int(rng.integers(1, 4))
        steps = rng.integers(0, 4, (n + 1, n + 1))
        lengths = rng.integers(0, 5, 6)
        bounds = np.append(0, np.cumsum(lengths))
        costs = rng.integers(0, 4, (int(bounds[-1]), n))
        got = tagger.best_paths(costs, bounds, steps)
        for a, b in zip(bounds, bounds[1:]):
            def price(path):
                ends = [n, *path, n]
                return sum(steps[x, y] for x, y in zip(ends, ends[1:])) + sum(costs[a + k, t] for k, t in enumerate(path))

            if a < b:
                every = list(itertools.product(range(n), repeat=int(b - a)))
                least = min(map(price, every))
                best = [p for p in every if price(p) == least]
                assert tuple(got[a:b]) == min(best, key=lambda p: p[::-1])
    assert len(tagger.best_paths(np.zeros((0, 2), int), np.array([0, 0]), np.zeros((3, 3), int))) == 0


def test_ambiguous_forms_follow_their_neighbours(spark, taught):
    model = tagger.learn(taught[1])
    new = [(1, 0, ["the", "man", "can", "rest"]), (1, 1, []), (2, 0, ["the", "can"]), (2, 1, ["the", "zzz", None]), (3, 0, ["a"] * 300)]
    table = spark.createDataFrame(new, "doc int, pos int, forms array<string>")
    got = {(r["doc"], r["pos"]): (r["forms"], r["tags"]) for r in tagger.tag_sentences(table, model, "doc").collect()}
    assert {k: f for k, (f, _) in got.items()} == {(d, p): f for d, p, f in new}
    assert got[1, 0][1][:3] == ["D", "N", "V"] and got[2, 0][1] == ["D", "N"] and got[1, 1][1] == []
    assert got[2, 1][1][1] == "N" and len(got[3, 0][1]) == 300
    costs = {r["form"]: r["costs"] for r in model.forms.collect()}
    for forms, tags in got.values():
        rows = np.array([[tagger.NEVER if c is None else c for c in costs[f]] if f in costs else model.unseen for f in forms], np.int64)
        if 0 < len(forms) < 5:
            ways = itertools.product(range(4), repeat=len(forms))
            price = lambda p: sum(model.steps[x, y] for x, y in zip([4, *p], [*p, 4])) + sum(rows[k, t] for k, t in enumerate(p))
            assert tags == [model.tags[t] for t in min(ways, key=lambda p: (price(p), p[::-1]))]


def test_missing_tags_empty_tables_and_large_tag_sets(spark, taught):
    holes = spark.createDataFrame([(1, 0, ["x", "y", "x"], ["A", None, "A"]), (1, 1, ["y"], [None])], taught[1].schema)
    model = tagger.learn(holes)
    assert model.tags == ["A"] and model.forms.count() == 1
    none = tagger.learn(holes.limit(0))
    assert none.tags == [] and tagger.tag_sentences(holes, none, "doc").count() == 2
    assert tagger.tag_sentences(holes.limit(0), model, "doc").count() == 0
    many = spark.range(tagger.MOST_TAGS + 1).selectExpr("array('f') AS forms", "array(cast(id AS string)) AS tags")
    with pytest.raises(ValueError):
        tagger.learn(many)


def test_rows_for_statistics(spark):
    tagged = spark.createDataFrame([(1, ["a", "b"], ["S", "V"]), (2, [], [])], "doc int, forms array<string>, tags array<string>")
    assert sorted(map(tuple, tagger.word_rows(tagged, "doc").collect()), key=str) == [(1, "a", "S"), (1, "b", "V"), (2, None, None)]


def test_small_batches_and_large_tables_give_the_same(spark, taught, monkeypatch):
    model = tagger.learn(taught[1])
    key = lambda df: sorted(map(tuple, df.select("doc", "pos", "forms", "tags").collect()))
    want = key(tagger.tag_sentences(taught[1].drop("tags"), model, "doc"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert key(tagger.tag_sentences(taught[1].drop("tags"), model, "doc")) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(tagger, "fits_broadcast", lambda df: False)
    assert key(tagger.tag_sentences(taught[1].drop("tags"), model, "doc")) == want


def test_large_table_of_forms_is_not_salted(spark, monkeypatch):
    """Frequent forms are broadcast, costs of rare ones come back to their sentence; the tags are the same."""
    rows = [(d, p, [f"w{(d * 7 + p * 3 + i) % 23}" for i in range(4)] + ["the", None]) for d in range(6) for p in range(3)] + [(9, 0, []), (None, 1, ["the", "w3"])]
    truth = spark.createDataFrame(rows, "doc int, pos int, forms array<string>")
    truth = truth.withColumn("tags", F.transform("forms", lambda w: F.when(w.isNotNull(), F.element_at(F.array(F.lit("A"), F.lit("B")), F.length(w) % 2 + 1))))
    model = tagger.learn(truth)
    plain = tagger.tag_sentences(truth, model, "doc", out="found").collect()
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(scale, "FREQUENT_ROWS", 2)
    out = tagger.tag_sentences(truth, model, "doc", out="found")
    assert "_salt" not in out._jdf.queryExecution().toString()
    key = lambda r: (r["doc"] or -1, r["pos"])
    assert sorted(out.collect(), key=key) == sorted(plain, key=key)
