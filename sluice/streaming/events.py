"""Streams of events and raw objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.store import KeyedTable

LATE = "24 hours"


def with_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as a timestamp, with a day's allowance for late rows."""
    return events.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", LATE)


def deduplicated(events: DataFrame, key: str) -> DataFrame:
    """Each key once within the allowance: cursors that read a day again bring rows twice."""
    return with_time(events).dropDuplicatesWithinWatermark([key])


def daily_entries(events: DataFrame, keys: list[str]) -> DataFrame:
    """day, keys, n: entries by reporting day, closed once the watermark has passed it."""
    shifted = with_time(events).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 330 MINUTES"))
    windows = shifted.groupBy(F.window("event_time", "1 day"), *keys).agg(F.count("*").alias("n"))
    return windows.select(F.col("window.start").cast("date").alias("day"), *keys, "n")


def engaged_days(events: DataFrame, keys: list[str]) -> DataFrame:
    """keys, user_id, event_time of each user once a key and reporting day: the distinct step of sliding_engaged, kept in state until the allowance has passed."""
    shifted = with_time(events).withColumn("event_time", F.date_trunc("day", F.col("event_time") + F.expr("INTERVAL 330 MINUTES")))
    return shifted.select(*keys, "user_id", "event_time").dropDuplicates([*keys, "user_id", "event_time"])


def sliding_engaged(events: DataFrame, keys: list[str], days: int = 7) -> DataFrame:
    """last_day, keys, user_id, of every user in the `days` reporting days up to each day, once: counting its rows counts users exactly.

    A user's day is dealt to the days it counts on, and each of them is kept once by state, so no count is approximate. The
    watermark of dealt days lies as far back as the longest window, so that late days still find theirs.
    """
    shifted = events.withColumn("event_time", F.date_trunc("day", F.col("ts").cast("timestamp") + F.expr("INTERVAL 330 MINUTES")))
    dealt = shifted.select(*keys, "user_id", F.explode(F.sequence("event_time", F.col("event_time") + F.expr(f"INTERVAL {days - 1} DAYS"), F.expr("INTERVAL 1 DAY"))).alias("event_time"))
    once = dealt.withWatermark("event_time", f"{days + 1} days").dropDuplicates([*keys, "user_id", "event_time"])
    return once.select(F.col("event_time").cast("date").alias("last_day"), *keys, "user_id")


def first_touch(events: DataFrame) -> DataFrame:
    """user_id, first_time, last_time, stage, n after each batch that brings events of the user: stage is that of the last event, the greater of equal times.

    The state is that of Spark's own streaming aggregation, a narrow row a user without expiry, so no Python runs; a batch's events
    are merged before the shuffle, and a hot user costs a row for each task.
    """
    last = F.max(F.struct("event_time", "event_type"))
    rows = with_time(events).groupBy("user_id").agg(F.min("event_time").alias("first_time"), last.alias("_last"), F.count("*").alias("n"))
    return rows.select("user_id", "first_time", F.col("_last.event_time").alias("last_time"), F.col("_last.event_type").alias("stage"), "n")


def upsert_batches(stream: DataFrame, table: KeyedTable, version: str, checkpoint: str) -> None:
    """Runs a stream of raw objects (with sha) into a keyed table, batch by batch: the newest payload of each key, those that it replaced, and how many were inserted, updated, unchanged and stale.

    Equal payloads change nothing. A batch that is repeated after a failure is written anew, or is done already (KeyedTable).
    """
    stream.writeStream.foreachBatch(lambda batch, number: table.merge(batch, number, version=version, compare=["sha"])).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
