import random
import re

import numpy as np
import pyarrow as pa
import pytest

from penprint.llm import decontaminate as d

rng = random.Random(9)
WORDS = [f"word{k}" for k in range(400)] + ["the", "of", "a"]


def item(n):
    return " ".join(rng.choices(WORDS, k=n - n // 4) + rng.choices(["the", "of", "a"], k=n // 4)) + "."


@pytest.fixture(scope="module")
def index():
    return d.Index([(k, *d.halves(item(rng.randrange(4, 40)))) for k in range(60)])


def test_search_equals_scoring_every_item(index):
    for _ in range(200):
        terms = np.unique(np.array(rng.sample(range(len(index.terms)), rng.randrange(1, 120))))
        total = np.zeros(len(index.ids))
        for t in terms:
            for items, impacts, _ in index.lists[t].values():
                total[items] += impacts
        for least in (0.05, 0.3, 0.5):
            got = [h for block in range(index.blocks) for h in index.search(terms.tolist(), block, least)]
            assert dict(got) == pytest.approx({i: s for i, s in enumerate(total) if s >= least})


def test_bounds_lose_no_passage(index, monkeypatch):
    monkeypatch.setattr(d, "OVERLAP", 0.0)
    monkeypatch.setattr(d, "RETRIEVE", 0.3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(0, 400))) for _ in range(30)]
    hashes, bounds = d.folded(pa.array(texts))
    got = index.leaks(hashes, bounds)
    for k in range(len(texts)):
        own, step = hashes[bounds[k] : bounds[k + 1]], index.longest
        want = set()
        for a in range(0, max(1, len(own) - step), step):
            passage = own[a : a + 2 * step]
            numbers = np.unique(index.numbers(passage))
            total = np.zeros(len(index.ids))
            for t in numbers[numbers >= 0]:
                for items, impacts, _ in index.lists[t].values():
                    total[items] += impacts
            for i in np.flatnonzero(total >= 0.3):
                share = index.overlaps(i, passage)
                if share[1] > 0 and share[2] > 0:
                    want.add(index.ids[i])
        assert set(got[k]) == want


def test_planted_items_and_odd_rows(spark):
    items = [(k, item(rng.randrange(8, 40))) for k in range(50)] + [(50, "Two words"), (51, None), (52, "..."), (None, item(9)), (3, "another text with the id of item three in it")]
    noise = lambda n: " ".join(rng.choices(WORDS, k=n))
    rows, want = [], set()
    for k in range(50):
        text = items[k][1] if k % 3 else items[k][1].upper().replace(" ", " !! ")
        rows.append((k, noise(rng.randrange(0, 300)) + "\n" + text + "\n" + noise(rng.randrange(0, 300))))
        want.add((k, k))
    edited = items[1][1].split()
    edited[0] = "changed"
    rows.append((60, noise(30) + " " + " ".join(edited) + " " + noise(30)))
    want |= {(60, 1)} if len(edited) > 12 else set()
    half = items[2][1].split()
    rows.append((61, " ".join(half[: len(half) // 3]) + " " + noise(50)))
    rows += [(62, None), (63, ""), (64, noise(60000) + " " + items[5][1]), (None, items[6][1]), (65, "two WORDS"), (66, noise(200)), (5, rows[5][1])]
    want |= {(64, 5), (None, 6), (65, 50)}
    docs = spark.createDataFrame([(i, t, "s", 0.5) for i, t in rows], "doc_id bigint, text string, item_id string, score double").repartition(3)
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    out = d.with_leaks(docs, table).collect()
    found = {(r["doc_id"], leak["item_id"]) for r in out for leak in r["leaks"]}
    assert found >= want and {i for i, _ in found - want} <= {60, 65}
    kept = d.decontaminated(docs, table)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {61, 62, 63, 66} and kept.where("doc_id < 50").count() == 0
    assert d.decontaminated(docs, table.limit(0)).count() == len(rows) and d.with_leaks(docs.limit(0), table).count() == 0


def test_question_and_answer_columns_and_several_indexes(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"question number q{k} about topic t{k} please", f"answer a{k}") for k in range(30)], "item_id bigint, question string, answer string")
    docs = spark.createDataFrame([(0, "x question number q4 about topic t4 please answer a4 y"), (1, "x question number q5 about topic t5 please")], "doc_id bigint, text string")
    for size in (d.SHARD, 300):
        monkeypatch.setattr(d, "SHARD", size)
        got = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in d.with_leaks(docs, items).collect()}
        assert got == {0: [4], 1: []}


def test_query_finds_every_whole_item(spark, small):
    norm = lambda s: " " + re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", (s or "").lower()) + " "
    items = [(r["item_id"], norm(r["text"]).strip()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], norm(r["text"])) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {(i, k) for i, t in docs for k, q in items if f" {q} " in t}
    assert {(r["doc_id"], r["item_id"]) for r in d.op7_decontaminate(spark, small).collect()} == want
