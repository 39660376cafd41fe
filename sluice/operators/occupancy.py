"""Where deals stand at the end of a day, from a state table a month and the days since."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.metrics import day

#: A deal's state: its last event.
STATE = ("deal_id", "rung", "reason", "entered_at", "event_id")


def last_events(events: DataFrame) -> DataFrame:
    """The last of each deal's events, by time and id, as STATE."""
    return events.groupBy("deal_id").agg(F.max_by(F.struct(*STATE[1:]), F.struct("entered_at", "event_id")).alias("s")).select("deal_id", "s.*")


def month_end(d: dt.date) -> dt.date:
    return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def _checkpoints(spark: SparkSession, path: str) -> list[str]:
    """The last days of the months that have a checkpoint, in order."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    ends = [s.getPath().getName().removeprefix("until=") for s in files.listStatus(top)] if files.exists(top) else []
    return sorted(e for e in ends if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/until={e}/_SUCCESS")))


def _read(spark: SparkSession, path: str, until: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.select(*STATE).schema).parquet(f"{path}/until={until}")


def write_checkpoints(events: DataFrame, path: str, through: str, *, again_from: str | None = None) -> list[str]:
    """Writes path/until=<last day of a month> for each month that ends up to `through` and has none: every deal's state then.

    Each comes from the one before and that month's events, so of a table that is parted by ist_day a month is read once. Where
    events of earlier days came in late, `again_from` is the first of these days: checkpoints from its month on are written anew. Returns
    the days that were written.
    """
    spark, last, written = events.sparkSession, dt.date.fromisoformat(through), []
    first = events.agg(F.min("ist_day")).first()[0]
    there = [e for e in _checkpoints(spark, path) if again_from is None or e < again_from]
    start = dt.date.fromisoformat(there[-1]) + dt.timedelta(days=1) if there else first
    while start is not None and month_end(start) <= last:
        end = month_end(start)
        own = last_events(events.filter(F.col("ist_day").between(day(str(start)), day(str(end)))))
        if there:
            own = last_events(own.unionByName(_read(spark, path, there[-1], events)))
        own.write.mode("overwrite").parquet(f"{path}/until={end}")
        there.append(str(end))
        written.append(str(end))
        start = end + dt.timedelta(days=1)
    return written


def states_at(events: DataFrame, path: str, d: str) -> DataFrame:
    """Every deal's state at the end of day d: the last checkpoint up to it, and the events of the days since."""
    spark = events.sparkSession
    before = [e for e in _checkpoints(spark, path) if e <= d]
    since = events.filter(F.col("ist_day") <= day(d))
    if not before:
        return last_events(since)
    since = since.filter(F.col("ist_day") > day(before[-1])).select(*STATE)
    return last_events(since.unionByName(_read(spark, path, before[-1], events)))


def counted(states: DataFrame) -> DataFrame:
    """state, rung, reason, deals: live, dead, won and unmapped deals."""
    state = F.when(F.col("rung") == "UNMAPPED", "unmapped").when(F.col("rung") == "DEAD", "dead").when(F.col("rung") == "WON", "won").otherwise("live")
    return states.groupBy(state.alias("state"), "rung", "reason").agg(F.count("*").alias("deals"))


def occupancy_on(events: DataFrame, path: str, deals: DataFrame, live: DataFrame, d: str, synced: str | None) -> DataFrame:
    """state, rung, reason, deals at the end of day d.

    From the day of the oldest sync on (`synced`; null if there was none) the present table of deals says it: live is deal_id, rung and
    reason of each, and archived deals are left out. Before that it is built from events (states_at), without deals that were
    archived by then or on an unknown day.
    """
    if synced is not None and d >= synced:
        there = deals.filter(~F.col("is_archived")).select(F.col("deal_id").alias("_d"))
        return counted(live.join(there, live["deal_id"] == there["_d"], "left_semi"))
    there = deals.filter(~F.col("is_archived") | (F.col("archived_day") > day(d))).select(F.col("deal_id").alias("_d"))
    states = states_at(events, path, d)
    return counted(states.join(there, states["deal_id"] == there["_d"], "left_semi"))
