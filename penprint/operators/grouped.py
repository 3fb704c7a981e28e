"""Grouped folds with class shares as alike as a greedy deal makes them.

Groups go, the most uneven first, to the fold with which the class shares of all folds spread least. Up to ``SHARD`` groups
are dealt in one go. More are cut into shards by a hash, each is dealt on its own, and then the shards' folds are matched
by the same rule, which takes one small table of a row per shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.scale import hash_order, lookup_join, settled

SHARD = 20_000


def spreads(folds: np.ndarray, add: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """For every fold: the mean over classes of the deviation of the folds' shares, if ``add`` went to it."""
    k = len(folds)
    trial = folds[None] + np.eye(k)[:, :, None] * add  # the fold that gets it, fold, class
    return (trial / totals).std(1).mean(1)


def dealt(counts: np.ndarray, k: int, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folds of groups in the given order, and the class counts of the folds; of equal folds the smaller, then the first."""
    folds = np.zeros((k, counts.shape[1]))
    out = np.empty(len(counts), np.int64)
    for i, add in enumerate(counts):
        out[i] = np.lexsort((np.arange(k), folds.sum(1), spreads(folds, add, totals).round(12)))[0]
        folds[out[i]] += add
    return out, folds


def matched(shards: list[np.ndarray], totals: np.ndarray) -> list[np.ndarray]:
    """For every shard where its folds go, so that the sums stay alike: the largest part first, each to a fold of its own."""
    k = len(shards[0])
    whole, out = np.zeros_like(shards[0]), []
    for folds in shards:
        free, target = list(range(k)), np.zeros(k, np.int64)
        for part in np.argsort(-folds.sum(1), kind="stable"):
            value = spreads(whole, folds[part], totals).round(12)
            best = min(free, key=lambda f: (value[f], whole[f].sum(), f))
            target[part] = best
            whole[best] += folds[part]
            free.remove(best)
        out.append(target)
    return out


def spread_group_folds(df: DataFrame, label: str, group: str, k: int = 5, seed: int = 42) -> DataFrame:
    """A fold per group: (group, n, fold). A group with rows of several classes counts with all of them.

    Rows of a null class or group are left out. Groups of equal unevenness are dealt in an order hashed from group and
    ``seed``, so the result does not depend on partitioning. The number of classes must be small: a group is a vector.
    """
    known = df.where(F.col(label).isNotNull() & F.col(group).isNotNull())
    cells = settled(known.groupBy(group, label).agg(F.count("*").alias("n")))
    sums = {r[label]: r["n"] for r in cells.groupBy(label).agg(F.sum("n").alias("n")).collect()}
    classes = sorted(sums, key=lambda c: (str(type(c)), c))
    totals = np.array([sums[c] for c in classes], float)
    columns = [F.sum(F.when(F.col(label) == F.lit(c), F.col("n")).otherwise(0)).alias(f"c{i}") for i, c in enumerate(classes)]
    groups = cells.groupBy(group).agg(F.sum("n").alias("n"), *columns).withColumn("_h", hash_order(group, seed))
    groups = settled(groups)
    parts = max(1, math.ceil(groups.count() / SHARD))
    sharded = groups.withColumn("_s", F.pmod(F.xxhash64("_h"), F.lit(parts)).cast("int"))
    names = [f"c{i}" for i in range(len(classes))]
    kind = dict(groups.dtypes)[group]

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        counts = rows[names].to_numpy(float)
        order = np.lexsort((rows["_h"].to_numpy(str), -counts.std(1).round(12)))
        fold = np.empty(len(rows), np.int64)
        fold[order], _ = dealt(counts[order], k, totals)
        return pd.DataFrame({group: rows[group], "n": rows["n"], "_s": rows["_s"], "fold": fold.astype("int32"), **{c: rows[c] for c in names}})

    schema = f"`{group}` {kind}, n bigint, _s int, fold int, " + ", ".join(f"{c} bigint" for c in names)
    if not names:
        return groups.select(group, "n", F.lit(0).alias("fold"))
    own = settled(sharded.groupBy("_s").applyInPandas(deal, schema))
    if parts == 1:
        return own.select(group, "n", "fold")
    tables = [np.zeros((k, len(names))) for _ in range(parts)]
    for r in own.groupBy("_s", "fold").agg(*[F.sum(c).alias(c) for c in names]).collect():
        tables[r["_s"]][r["fold"]] = [r[c] for c in names]
    order = np.argsort([-t.std() for t in tables], kind="stable")
    targets = matched([tables[s] for s in order], totals)
    moves = [(int(s), f, int(t)) for s, target in zip(order, targets) for f, t in enumerate(target)]
    named = df.sparkSession.createDataFrame(moves, "_s int, fold int, _to int")
    return lookup_join(own, named, ["_s", "fold"]).select(group, "n", F.col("_to").alias("fold"))
