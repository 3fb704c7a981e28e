"""Service usage from an event table: users, requests, ratings.

An event has (event_id, ts, user_id, event_type, value). ``signup`` registers a
user, ``click`` and ``view`` are requests, ``purchase`` carries a rating.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.operators.scale import lookup_join, running_totals, settled

REGISTER = "signup"
REQUESTS = ["click", "view"]
RATING = "purchase"


def rating_of(value: Column | str = "value") -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return (F.lit(1) + F.floor(column) % 5).cast("int")


def registered_users(events: DataFrame) -> DataFrame:
    """One row per user with the first registration; later ones are refused."""
    signups = events.where(F.col("event_type") == REGISTER)
    return signups.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("since"))


def accepted(events: DataFrame, users: DataFrame, types: list[str]) -> DataFrame:
    """Events of known users after their registration; others are refused.

    One user may own a large part of the events, so users are broadcast if few,
    and salted otherwise.
    """
    rows = events.where(F.col("event_type").isin(types))
    known = lookup_join(rows, users, ["user_id"], salt_on=["event_id"])
    return known.where(F.struct("ts", "event_id") > F.col("since")).drop("since")


def user_requests(events: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, requests) of all registered users, zero included."""
    users = settled(registered_users(events)) if users is None else users
    counted = accepted(events, users, REQUESTS).groupBy("user_id").agg(F.count("*").alias("requests"))
    return users.select("user_id").join(counted, "user_id", "left").fillna(0, ["requests"])


def user_ratings(events: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, rating) of all registered users; the last rating counts, none is null."""
    users = settled(registered_users(events)) if users is None else users
    rated = accepted(events, users, [RATING]).groupBy("user_id").agg(
        F.max_by(rating_of(), F.struct("ts", "event_id")).alias("rating")
    )
    return users.select("user_id").join(rated, "user_id", "left")


def user_states(events: DataFrame) -> DataFrame:
    """(id, requests, rating): the user table after all events."""
    users = settled(registered_users(events))
    rows = accepted(events, users, [*REQUESTS, RATING])
    is_rating = F.col("event_type") == RATING
    state = rows.groupBy("user_id").agg(
        F.count_if(~is_rating).alias("requests"),
        F.max_by(rating_of(), F.when(is_rating, F.struct("ts", "event_id"))).alias("rating"),
    )
    joined = users.select("user_id").join(state, "user_id", "left").fillna(0, ["requests"])
    return joined.select(F.col("user_id").alias("id"), "requests", "rating")


def get_user(states: DataFrame, user_id: int) -> DataFrame:
    return states.where(F.col("id") == user_id)


def usage_summary(states: DataFrame) -> DataFrame:
    """One row: users, requests, and the mean rating of users that rated (else 0)."""
    return states.agg(
        F.count("id").alias("total_users"),
        F.coalesce(F.sum("requests"), F.lit(0)).cast("bigint").alias("total_requests"),
        F.bround(F.coalesce(F.avg("rating"), F.lit(0.0)), 2).alias("avg_rating"),
    )


def running_rating(votes: DataFrame, order: list[str], vote: str = "vote", first: int = 5) -> DataFrame:
    """Running number and mean of votes, starting from one vote of ``first``.

    Only votes from 1 to 5 count; other rows show the state they leave unchanged.
    """
    valid = F.col(vote).between(1, 5)
    totals = running_totals(
        votes,
        order,
        {"_n": valid.cast("bigint"), "_s": F.when(valid, F.col(vote)).otherwise(0).cast("bigint")},
    )
    return totals.withColumns(
        {"n_votes": F.col("_n") + 1, "mean_vote": (F.col("_s") + first) / (F.col("_n") + 1)}
    ).drop("_n", "_s")
