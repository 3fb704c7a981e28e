import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from penprint.llm import collocations


def plain(rows, least, longest=4, covered=80, most=2000):
    """All phrases by counting every run in plain Python."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    out = []
    for lang in n:
        own = {p: a for (x, p), a in f.items() if x == lang and a >= least}
        rows_ = []
        for p, a in own.items():
            if len(p) == 1:
                continue
            score, _, l, r = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            inside = [q for q in own if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * own[q] >= covered * a for q in inside):
                rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def made(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "é", "Straße", "a", "b", "times", "\x00x", "日本"]
    weights = [9, 7, 4, 4, 3, 2, 5, 5, 2, 1, 1]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(["New York times", "the of", "a a a a"]) if rng.random() < 0.2 else rng.choices(vocabulary, weights)[0])
        rows.append((rng.choice([" ", "\t ", ", "]).join(parts), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" ,.;\n", "fr"), ("New York times " * 50 + "\n" + "a " * 40, "en")] + rows[:2]


@pytest.mark.parametrize("work", [{}, {"block": 150, "tile": 3, "cells": 6}])
def test_equal_to_plain_counting(spark, work):
    rows = made(len(work))
    docs = spark.createDataFrame([(k, t, lang, 0, "w") for k, (t, lang) in enumerate(rows)], "doc_id int, text string, lang string, n int, phrase string")
    got = collocations.collocations(docs.repartition(5), least=5, **work)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 5)


def test_fewer_rows_and_other_limits(spark):
    rows = made(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = collocations.collocations(docs, least=3, longest=3, covered=50, most=4, tile=10)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 3, 50, 4)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs, least=10**6).count() == 0


def test_tiles_name_every_pair_once():
    rng = np.random.default_rng(1)
    grid = collocations.Grid({"x": np.array([0, 1, 5, 40])}, {"x": np.array([0, 2, 9])}, {"x": 30})
    left, right = rng.integers(0, 90, 500), rng.integers(0, 30, 500)
    tile, cell = grid.place("x", left, right)
    for t, c, a, b in zip(tile, cell, left, right):
        back = grid.pairs("x", int(t), np.array([c]))
        assert (back[0][0], back[1][0]) == (a, b)
        size = grid.cells("x", int(t))
        assert size == 0 or c < size
    assert grid.cells("x", 0) == 2 and grid.cells("x", 11) == 0 and grid.cells("other", 0) == 0


def test_partial_counts_add_up_dense_and_sparse():
    rng = np.random.default_rng(2)
    want = Counter()
    sums = [collocations.Sums(100, 100), collocations.Sums(0, 100)]
    for _ in range(5):
        cells = rng.integers(0, 100, 80)
        want.update(cells.tolist())
        for size, s in zip((100, 0), sums):
            s.add(*collocations.counted(cells, size, 100))
    for s in sums:
        at, n = s.frequent(3)
        assert dict(zip(at.tolist(), n.tolist())) == {c: k for c, k in want.items() if k >= 3}


def test_long_texts_are_cut_at_breaks_only():
    data = np.frombuffer(b"ab cd. ef gh\nij kl, mn", np.uint8)
    for most in (1, 3, 7, 50):
        parts = [p.tobytes() for p in collocations.slices(data, most)]
        assert b"".join(parts) == data.tobytes() and all(p[-1:] in b".,\n" for p in parts[:-1])


def test_query_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(con.execute(collocations.SQL).fetchall())
    got = collocations.op11_collocations(spark, small)
    assert len(want) >= 50 and sorted(map(tuple, got.collect())) == want
