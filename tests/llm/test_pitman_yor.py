import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from penprint.llm import pitman_yor as py
from penprint.llm import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def tokens_of(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def check_counts(out, rows):
    """``rows``: id, text, learned."""
    count = Counter(w for _, t, learn in rows if learn for w in tokens_of(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t, learn in rows:
        w = tokens_of(t)
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want.append((i is not None, i, learn, len(w), sum(count[x] > 0 for x in w), n, round(base, 6)))
    got = [(r["id"] is not None, r["id"], r["learned"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_packing():
    rng = np.random.default_rng(0)
    for values in ([], [0], [255, 256, 3], rng.integers(0, 1 << 40, 500)):
        assert py.unpack(py.pack(np.array(values, np.int64))).tolist() == list(values)
    keys = rng.integers(0, 1 << py.KEY, 100, np.uint64)
    assert (py.unpack_keys(py.pack_keys(keys)) == keys).all()


def test_seating_follows_the_restaurant_process():
    """Expected tables of n customers of one dish, by dynamic programming over the number of tables."""
    rng = np.random.default_rng(1)
    for n, mass, discount in ((12, 0.7, 0.5), (200, 1.5, 0.75)):
        chance = {1: 1.0}
        for i in range(1, n):
            new = Counter()
            for t, p in chance.items():
                q = mass / (mass + i - discount * t)
                new[t + 1] += p * q
                new[t] += p * (1 - q)
            chance = new
        mean = sum(t * p for t, p in chance.items())
        got = py.seated(rng, np.full(20000, n), np.full(20000, mass), discount)
        assert abs(got.mean() - mean) < 0.06 * mean
    assert py.seated(rng, np.array([0, 1, 5]), np.full(3, 1e-12), 0.8).tolist() == [0, 1, 1]


def test_words_that_share_forty_bits_of_their_hash_stay_apart(spark):
    a, b = "k1159980", "k2753023"
    hashes = words.word_hashes(pa.array([a, b]))[0]
    assert hashes[0] != hashes[1] and hashes[0] >> np.uint64(24) == hashes[1] >> np.uint64(24)
    rows = [(1, f"{a} x {a}", True), (2, b, False), (3, f"{b} x", False), (4, a, False)]
    for part in (rows, [*rows, (5, f"{b} y", True)]):
        check_counts(py.scored(frame(spark, part), F.col("learn"), buckets=3).collect(), part)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = []
    for _ in range(120):
        w = [rng.choice(vocabulary)]
        for _ in range(rng.randrange(0, 30)):  # a word is mostly followed by the next one
            w.append(vocabulary[(int(w[-1][1:]) + 1) % 40] if rng.random() < 0.7 else rng.choice(vocabulary))
        texts.append(" ".join(w).upper() if rng.random() < 0.2 else "\t".join(w))
    texts += ["", None, " \n", "unseen words only", texts[3], texts[3], "w1 " * 30000]
    rows = [(k, t, zlib.crc32(str(k).encode()) % 5 != 1) for k, t in enumerate(texts)]
    return [*rows, (None, "w1 w2", True), (5, texts[5], rows[5][2])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, 1) for i, t, x in rows], "doc_id bigint, text string, learn boolean, score int").repartition(3)


def test_counts_and_odd_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(py, "BLOCK", 2000)  # many blocks, most contexts split
    for buckets in (3, 40):
        out = py.scored(frame(spark, rows), F.col("learn"), buckets=buckets).collect()
        check_counts(out, rows)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    held = [r for r in out if not r["learned"] and r["n_known"] == r["n_tokens"] and 5 < r["n_tokens"] < 1000]
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_probabilities_of_all_words_add_up_to_one(spark, rows):
    """One-word texts after the start, and the place of unseen words, share the whole probability."""
    learn = [(k, t, True) for k, (_, t, _) in enumerate(rows[:60])]
    known = sorted({w for _, t, _ in learn for w in tokens_of(t) if w})
    probes = [(1000 + k, w, False) for k, w in enumerate([*known, "never-seen"])] + [(5000, "", False)]
    doubled = [(2000 + k, f"{w} w1", False) for k, w in enumerate(known)]
    out = {r["id"]: 10 ** r["score"] for r in py.scored(frame(spark, learn + probes + doubled), F.col("learn")).collect()}
    # P(word | start) = P(word end) / P(end | word), and P(end | word) by the other probes cannot be told apart; with
    # the end token as a word, the sum over words of P(word end) + ... stays below one and P(end | start) is one term
    singles = sum(out[1000 + k] for k in range(len(known) + 1)) + out[5000]
    assert 0 < singles < 1
    assert all(out[2000 + k] < 1 for k in range(len(known)))


def test_every_word_has_its_own_parent_probability_at_any_size(spark, monkeypatch, tmp_path):
    def sampled(seed, restaurant, parts, customers, parent, discount, strength, inner=py.sampled):
        np.save(tmp_path / f"{seed}.npy", np.array([customers, parent]))
        return inner(seed, restaurant, parts, customers, parent, discount, strength)

    monkeypatch.setattr(py, "sampled", sampled)
    rare = [f"r{k}" for k in range(30)]
    learn = [(0, "w1 " * 300000, True), *((k + 1, f"w1 {w} " * (k % 4 + 1), True) for k, w in enumerate(rare))]
    py.scored(frame(spark, [*learn, (99, "r3 unseen r5", False)]), F.col("learn"), buckets=5).collect()
    count, pairs = Counter(), Counter()
    for _, t, _ in learn:
        w = tokens_of(t)
        count.update(w)
        pairs.update(zip(["start", *w[:-1]], w) if w else ())
    want = sorted((n, count[w] / sum(count.values())) for (_, w), n in pairs.items())
    saved = np.concatenate([np.load(f) for f in tmp_path.glob("*.npy")], axis=1)
    got = sorted((int(n), p) for n, p in saved.T if n)
    assert [n for n, _ in got] == [n for n, _ in want] and np.allclose([p for _, p in got], [p for _, p in want], rtol=1e-12)


def test_nothing_to_learn_and_empty_tables(spark, rows):
    none = [(i, t, False) for i, t, _ in rows]
    out = py.scored(frame(spark, none), F.col("learn")).collect()
    assert len(out) == len(rows) and all(r["train_tokens"] == 0 and r["base_score"] == 0 and abs(r["score"]) < 1e-9 for r in out)
    assert py.scored(frame(spark, rows).limit(0), F.col("learn")).count() == 0


def test_query_beats_frequencies_on_held_out_texts(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = py.op8_pitman_yor(spark, small).collect()
    check_counts([{**r.asDict(), "id": r["doc_id"], "learned": not r["held_out"]} for r in out], [(i, t, zlib.crc32(str(i).encode()) % 5 != 1) for i, t in texts.items()])
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
