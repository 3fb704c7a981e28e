"""Usage statistics over an event stream.

Every micro-batch is reduced on its own and written under its number; what is read adds the batches up. So nothing is
kept in the stream's state, events may arrive in any order and however late, and a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from penprint.operators.usage import RATING, REGISTER, REQUESTS, rating_of, user_states

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def event_stream(spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Event files arriving in a folder; event time in the session's zone."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def _windowed(events: DataFrame, width: str) -> DataFrame:
    rated = F.col("event_type") == RATING
    return (
        events.groupBy(F.window("ts", width).alias("w"))
        .agg(
            F.count_if(F.col("event_type") == REGISTER).alias("n_signups"),
            F.count_if(F.col("event_type").isin(REQUESTS)).alias("n_requests"),
            F.count_if(rated).alias("n_ratings"),
            F.coalesce(F.sum(F.when(rated, rating_of())), F.lit(0)).cast("bigint").alias("sum_ratings"),
        )
        .select(window_start(), "n_signups", "n_requests", "n_ratings", "sum_ratings")
    )


def window_start() -> Column:
    return F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start")


def usage_windows(width: str = "30 seconds") -> Callable[[DataFrame], DataFrame]:
    """Sign-ups, requests and ratings of one batch per window."""
    return lambda batch: _windowed(batch, width)


def timely_windows(events: DataFrame, delay: str, width: str = "30 seconds") -> DataFrame:
    """The same counts kept in the stream's state; events later than ``delay`` are left out."""
    return _windowed(events.withWatermark("ts", delay), width)


def new_users(batch: DataFrame) -> DataFrame:
    """First sign-up per user of one batch."""
    signups = batch.where(F.col("event_type") == REGISTER)
    return signups.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("since"))


def user_events(batch: DataFrame) -> DataFrame:
    """The columns and rows that user counters need."""
    wanted = F.col("event_type").isin([REGISTER, RATING, *REQUESTS])
    return batch.where(wanted).select("event_id", "ts", "user_id", "event_type", "value")


def write_parts(
    stream: DataFrame, part: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Write what ``part`` makes of every micro-batch; ``every=None`` drains what has arrived and stops."""

    def save(batch: DataFrame, number: int) -> None:
        part(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def write_updates(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Write changed rows of a stream with state per micro-batch; a repeated batch overwrites itself."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Counts per window over all batches."""
    sums = [F.sum(c).alias(c) for c in ("n_signups", "n_requests", "n_ratings", "sum_ratings")]
    return spark.read.parquet(path).groupBy("window_start").agg(*sums)


def read_new_users(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, since): the earliest sign-up over all batches."""
    return spark.read.parquet(path).groupBy("user_id").agg(F.min("since").alias("since"))


def read_user_counters(spark: SparkSession, path: str) -> DataFrame:
    """(id, requests, rating) of registered users; what precedes the registration is refused, as in a batch job."""
    return user_states(spark.read.parquet(path).drop("batch"))


def latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The last written state of every key."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (key, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("v")
    return rows.groupBy(key).agg(newest).select(key, "v.*")
