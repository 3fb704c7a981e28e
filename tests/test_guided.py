import math
import random
import statistics

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from penprint.plans import classifiers, guided
from penprint.plans.search import draw

SPACE = {"x": (-5.0, 5.0, "even"), "rate": (1e-4, 1.0, "log"), "depth": (1, 12, "int"), "kind": ["a", "b", "c"]}


def known(params, fold=0):
    """Highest at x = 1, rate = 0.01, depth = 4, kind b."""
    return -((params["x"] - 1) ** 2) / 5 - (math.log10(params["rate"]) + 2) ** 2 - abs(params["depth"] - 4) / 3 - (params["kind"] != "b")


def test_later_half_beats_random_draws():
    later, chance = [], []
    for seed in range(8):
        trials = sorted(guided.guided_search(known, SPACE, n_trials=30, seed=seed), key=lambda t: t.number)
        later.append(statistics.fmean(t.score for t in trials[15:]))
        rng = random.Random(1000 + seed)
        chance.append(statistics.fmean(known(draw(SPACE, rng)) for _ in range(15)))
    assert statistics.fmean(later) > statistics.fmean(chance) + 0.8 and sum(a > b for a, b in zip(later, chance)) >= 7


def test_values_stay_in_their_ranges():
    for t in guided.guided_search(known, SPACE, n_trials=40, seed=3):
        assert -5 <= t.params["x"] <= 5 and 1e-4 <= t.params["rate"] <= 1
        assert isinstance(t.params["depth"], int) and 1 <= t.params["depth"] <= 12 and t.params["kind"] in "abc"


def test_same_seed_same_trials_and_best_first():
    one, two = (guided.guided_search(known, SPACE, n_trials=20, seed=5) for _ in range(2))
    assert [t.params for t in one] == [t.params for t in two]
    assert [t.score for t in one] == sorted((t.score for t in one), reverse=True)


def test_hopeless_trials_end_early_and_come_last():
    calls = []

    def measure(params, fold):
        calls.append(fold)
        return known(params) + 0.01 * fold

    trials = guided.guided_search(measure, SPACE, folds=4, n_trials=25, seed=1)
    whole, ended = [t for t in trials if not t.ended], [t for t in trials if t.ended]
    assert ended and len(calls) < 100 and trials == whole + ended
    assert all(len(t.scores) == 4 for t in whole) and all(len(t.scores) < 4 for t in ended)
    assert len(guided.guided_search(measure, SPACE, folds=4, n_trials=6, prune=False)[0].scores) == 4


def test_density_is_high_where_trials_are():
    d = guided.Density([0.0, 0.1, 0.2], -5.0, 5.0)
    assert d.height(0.1) > 3 * d.height(3.0) and guided.Density([], 0.0, 1.0).height(0.5) > 0
    assert guided.back(guided.straight(0.02, (1e-3, 1.0, "log")), (1e-3, 1.0, "log")) == pytest.approx(0.02)


def test_tunes_boosted_trees(spark):
    rows = spark.range(120).select(
        F.array(F.sin(F.col("id") * 1.7), F.cos(F.col("id") * 0.9), F.rand(3)).alias("v"), (F.sin(F.col("id") * 1.7) > 0.2).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))
    rows = rows.withColumn("vec", array_to_vector("v"))
    space = {"iterations": (1, 2, "int"), "learning_rate": (0.05, 0.3, "log"), "l2_leaf_reg": (0.1, 3, "log"), "max_depth": (1, 2, "int")}
    trials = guided.tune_guided(lambda p, n: ([], [classifiers.softmax_boosted("vec", p)]), space, rows, k=2, n_trials=3)
    table = guided.trials_table(trials, spark).collect()
    assert len(table) == 3 and table[0]["score"] > 0.8 and {r["n_folds"] for r in table} <= {1, 2}
