import math

import numpy as np

from penprint.llm import vectors


def brute(rows, threshold=0.98):
    links, parent = {}, {}
    for i, v, c in rows:
        links.setdefault(i, 0)
        parent.setdefault(i, i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [
        (i, np.array(v, float), c)
        for i, v, c in rows
        if v and c is not None and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    for k, (i, v, c) in enumerate(good):
        for j, w, e in good[k + 1 :]:
            if c == e and len(v) == len(w) and i != j:
                a, b = v / np.abs(v).max(), w / np.abs(w).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in links if i is not None}


def test_links_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for c in (0, 1, 2):
        for _ in range(30):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 5)):
                rows.append((len(rows), (base + rng.normal(size=16) * rng.choice([0, 0.05, 0.14])).astype(np.float32).tolist(), int(c)))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(60)]  # copies
    rows += [(len(rows) + k, [x * 3 for x in rows[5][1]], rows[5][2]) for k in range(3)]  # another length
    rows += [(len(rows), rows[0][1], None), (len(rows) + 1, None, 0), (len(rows) + 2, [], 0), (len(rows) + 3, [0.0] * 16, 0), (len(rows) + 4, [float("nan")] + [1.0] * 15, 0)]
    rows += [(len(rows), [None] + [1.0] * 15, 0), (len(rows) + 1, [float("inf")] * 16, 0), (len(rows) + 2, [1.0, 2.0], 0), (len(rows) + 3, [2.0, 4.0], 0), (len(rows) + 4, [1e30] + [0.0] * 15, 1), (len(rows) + 5, [1e-30] + [-0.0] * 15, 1)]
    rows += [(None, rows[0][1], 0), (0, rows[0][1], 0)]
    monkeypatch.setattr(vectors, "TILE", 32)
    table = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], "vec_id bigint, embedding array<float>, label int, n_links string").repartition(6)
    out = vectors.near_vectors(table)
    assert set(out.columns) == {"vec_id", "embedding", "label", "n_links", "component_id", "kept"}
    got = out.collect()
    assert len(got) == len(rows)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows[:-1]]
    want = brute(exact)
    for r in got:
        if r["vec_id"] is not None:
            assert (r["n_links"], r["component_id"]) == want[r["vec_id"]] and r["kept"] == (r["component_id"] == r["vec_id"])
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
    assert max(n for n, _ in want.values()) >= 60
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_early_stops_lose_nothing():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(150, 24))
    b = np.vstack([a[:70] + 0.12 * rng.normal(size=(70, 24)), rng.normal(size=(80, 24))])
    axes = np.linalg.svd(np.vstack([a, b]), full_matrices=False)[2].T
    for threshold in (0.9, 0.98, 0.995):
        cosine = vectors.unit(a) @ vectors.unit(b).T
        assert set(zip(*vectors.close(a, b, axes, threshold))) == set(zip(*np.nonzero(cosine >= threshold)))


def test_stars_keep_components():
    a, b = np.array([5, 9, 7, 1, 30]), np.array([9, 7, 12, 2, 31])
    x, y = vectors.stars(a, b)
    assert sorted(zip(x.tolist(), y.tolist())) == [(2, 1), (7, 5), (9, 5), (12, 5), (31, 30)]


def test_real_table(spark, small):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = brute(rows)
    got = vectors.op10_vectors(spark, small).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
