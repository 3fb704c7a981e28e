import zlib

import numpy as np
import pytest

from penprint.llm import compression, toxicity

FOLDER = "/root/testdata/sf0.1"


def joined(spark, rows, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    return [(r, labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_held_out_toxicity(spark):
    rows = toxicity.op9_toxicity(spark, FOLDER).collect()
    assert len(rows) == 10000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = joined(spark, rows, "toxic")
    hits = sum(r["predicted"] * y for r, y in held)
    assert hits / sum(r["predicted"] for r, _ in held) > 0.85 and hits / sum(y for _, y in held) > 0.8
    assert sum(r["predicted"] == y for r, y in held) / len(held) > 0.96


def test_held_out_quality(spark):
    rows = compression.op5_quality(spark, FOLDER).collect()
    assert len(rows) == 10000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = joined(spark, rows, "quality")
    assert sum(r["predicted"] == y for r, y in held) / len(held) > 0.95
    good, bad = ([r["score"] for r, y in held if y == q] for q in (1, 0))
    assert np.mean([g > b for g in good[:200] for b in bad]) > 0.97


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (compression, "quality")])
def test_odd_rows(spark, module, label):
    texts = ["fine calm words here"] * 40 + ["idiot scum trash !!! !!!"] * 20 + [None, "", "é" * 200000]
    rows = [(i, t, 0.5, "x") for i, t in enumerate(texts)] + [(None, "idiot", 0.1, None), (1, "fine calm words here", 0.5, "x")]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, score double, {label} string")
    marks = [(i, int("idiot" in (t or "")), 3) for i, t in enumerate(texts[:60])] + [(5, None, 3), (None, 1, 3), (3, 0, 3), (900, 1, 3)]
    labels = spark.createDataFrame(marks, f"doc_id bigint, {label} int, text int")
    for known in (labels, labels.limit(0), labels.where(f"{label} = 1"), labels.where(f"{label} = 0")):
        out = module.scored(docs, module.fit(docs, known), "score").collect()
        assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
        assert {r[label] for r in out} == {"x", None}
        if known is labels:
            by = {r["doc_id"]: r["score"] for r in out}
            assert by[45] > by[5]
    assert module.scored(docs.limit(0), module.fit(docs.limit(0), labels)).count() == 0


def test_block_sums_cover_the_whole_text():
    sizes = compression.Sizes(b"good words " * 200, b"bad!! stuff!! " * 200)
    assert sizes.difference(b"") == 0.0
    assert sizes.difference(b"good words " * 900) > 0 > sizes.difference(b"bad!! stuff!! " * 900)
    assert sizes.difference(b"good words " * 90 + b"bad!! stuff!! " * 9000) < sizes.difference(b"good words " * 90)


def test_risk_keeps_unlabelled_positives_and_meets_the_prior():
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.2
    rows = [np.unique(np.append(rng.integers(100, 400, 20), rng.integers(0, 10, 3) if t else [])).astype(np.int32) for t in y]
    chosen = np.append(np.flatnonzero(y)[:200], np.arange(3000))
    slots = np.concatenate([rows[i] for i in chosen])
    bounds = np.append(0, np.cumsum([len(rows[i]) for i in chosen]))
    table, base = toxicity.fitted(slots, bounds, np.arange(len(chosen)) < 200, 0.2)
    p = toxicity.sigmoid(np.array([table[r].sum() for r in rows]) + base)
    assert abs(p.mean() - 0.2) < 0.02 and ((p >= 0.3) == y).mean() > 0.97
