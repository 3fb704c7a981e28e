from datetime import datetime, timedelta

import pytest

from penprint.operators import usage

START = datetime(2024, 1, 1)


def events(spark, rows):
    full = [(i, START + timedelta(seconds=t), u, k, v) for i, (t, u, k, v) in enumerate(rows)]
    return spark.createDataFrame(full, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def test_two_active_users(spark):
    """Three requests and a five, five requests and a four."""
    rows = [(0, 1, "signup", 0.0), (0, 2, "signup", 0.0), (1, 1, "signup", 0.0)]
    rows += [(2 + i, 1, "click", 0.0) for i in range(3)] + [(9 + i, 2, "view", 0.0) for i in range(5)]
    rows += [(20, 1, "purchase", 0.0), (21, 1, "purchase", 4.0), (22, 2, "purchase", 3.5)]
    rows += [(30, 7, "click", 0.0), (31, 7, "purchase", 4.0)]
    states = usage.user_states(events(spark, rows))
    assert [tuple(r) for r in states.orderBy("id").collect()] == [(1, 3, 5), (2, 5, 4)]
    assert tuple(usage.usage_summary(states).first()) == (2, 8, 4.5)
    assert tuple(usage.get_user(states, 2).first()) == (2, 5, 4)
    assert usage.get_user(states, 7).isEmpty()


def test_inactive_and_empty(spark):
    states = usage.user_states(events(spark, [(0, 1, "signup", 0.0), (1, 2, "signup", 0.0)]))
    assert tuple(usage.usage_summary(states).first()) == (2, 0, 0.0)
    nobody = usage.user_states(events(spark, [(0, 1, "click", 0.0)]))
    assert tuple(usage.usage_summary(nobody).first()) == (0, 0, 0.0)


def test_requests_before_registration_are_refused(spark):
    rows = [(0, 1, "click", 0.0), (1, 1, "signup", 0.0), (2, 1, "click", 0.0), (1, 1, "view", 0.0)]
    table = events(spark, rows)
    assert [tuple(r) for r in usage.user_requests(table).collect()] == [(1, 2)]
    assert [tuple(r) for r in usage.user_ratings(table).collect()] == [(1, None)]


def test_half_even_rounding(spark):
    states = spark.createDataFrame([(i, 0, 1 if i else 2) for i in range(8)], "id long, requests long, rating int")
    assert usage.usage_summary(states).first()["avg_rating"] == 1.12


def test_running_votes(spark):
    votes = spark.createDataFrame([(1, 5), (2, 0), (3, 1), (4, 9), (5, 3)], "n int, vote int")
    rows = usage.running_rating(votes.repartition(3), ["n"]).orderBy("n").collect()
    assert [r["n_votes"] for r in rows] == [2, 2, 3, 3, 4]
    assert [r["mean_vote"] for r in rows] == pytest.approx([5, 5, 11 / 3, 11 / 3, 14 / 4])
