import random
import re
from collections import defaultdict

import numpy as np
import pytest

from penprint.llm import near
from penprint.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def brute(rows):
    """Components of all pairs that share a shingle, checked one by one; rows of one id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    where = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for g in s:
            where[g].add(k)
    for k, (i, s) in enumerate(sets):
        for o in set().union(*(where[g] for g in s)) if s else ():
            j, t = sets[o]
            n = len(s & t)
            if o > k and 100 * n >= 75 * (len(s) + len(t) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def check(docs, rows):
    out = near.near_duplicates(docs).collect()
    want = brute(rows)
    assert len(out) == len(rows)
    assert sorted((r["id"] is not None, r["id"], r["n_shingles"]) for r in out) == sorted((i is not None, i, len(shingle_set(t))) for i, t in rows)
    for r in out:
        assert r["component_id"] == want.get(r["id"]) and r["kept"] == (r["id"] == r["component_id"])


def test_families_chains_and_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, number = [], iter(range(10_000))
    for size, length in ((40, 60), (25, 200), (3, 12), (2, 5), (6, 30)):
        base = rng.choices(vocabulary, k=length)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, length // 12))):
                copy[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((next(number), " ".join(copy).upper() if rng.random() < 0.3 else "\t ".join(copy)))
    chain = rng.choices(vocabulary, k=120)  # each is near the next, the ends are not near each other
    for k in range(12):
        rows.append((next(number), " ".join(chain[8 * k : 8 * k + 90] if k else chain[:90])))
    line = " ".join(rng.choices(vocabulary, k=9))  # a line that many short documents share
    rows += [(next(number), line + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for _ in range(40)]
    rows += [(next(number), t) for t in ("", None, " \n", "a", "A", "a b", "b a", "a b c d", "A  B c D", "é", "É", "long words here now " * 20000)]
    rows += [(7, rows[7][1]), (7, "another text under the same id with several words"), (None, rows[0][1]), (None, None)]
    rows += [(next(number), "another text under the same id with several words")]
    monkeypatch.setattr(near, "TILE", 16)  # several tiles in a family and a cluster
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id bigint, text string, n int, digest string").repartition(5)
    check(docs, rows)
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = brute(rows)
    assert sorted(i for i in ids if i is not None) == sorted({i for i in want if want[i] == i}) and ids.count(None) == 2
    assert near.near_duplicates(docs.limit(0)).count() == 0 and near.deduplicated(docs.limit(0)).count() == 0


def test_real_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_products_equal_set_sizes():
    rng = np.random.default_rng(1)
    a = [np.unique(rng.integers(0, 60, rng.integers(0, 50), np.uint64)) for _ in range(40)]
    b = [np.unique(np.append(s[: len(s) - 2], rng.integers(0, 90, 3, np.uint64))) for s in a]

    def close(x, y):
        n = len(set(x.tolist()) & set(y.tolist()))
        return n > 0 and 100 * n >= 75 * (len(x) + len(y) - n)

    assert set(zip(*near.similar(a, b, 75))) == {(i, j) for i in range(40) for j in range(40) if close(a[i], b[j])}
    assert set(zip(*near.similar(a, None, 75))) == {(i, j) for i in range(40) for j in range(i + 1, 40) if close(a[i], a[j])}


def test_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    shared, rest = rng.integers(0, 1 << 63, 3000, np.uint64), rng.integers(0, 1 << 63, 2000, np.uint64)
    sets = [np.unique(np.append(shared, rest[:1000])), np.unique(np.append(shared, rest[1000:]))]
    rows = near.signatures(np.concatenate(sets), np.array([0, 4000, 8000]))
    assert abs((rows[0] == rows[1]).mean() - 0.6) < 0.25
    empty = near.signatures(np.zeros(0, np.uint64), np.array([0, 0]))
    assert empty.shape == (1, near.COORDINATES)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(3)
    if shape == "path":
        links = [(k, k + 1) for k in range(0, 200)]
    elif shape == "star":
        links = [(500, k) for k in range(400)] + [(900, 901), (901, 900), (7, 7)]
    else:
        links = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    parent = {i: i for p in links for i in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {i for a, b in links if a != b for i in (a, b)}
    got = components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in got} == {i: find(i) for i in linked} and len(got) == len(linked)
