"""Stage events: enriched, in order, and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def effective_stages(stage_map: DataFrame, rungs: DataFrame, reasons: DataFrame, stages: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """Stages with their rung's depth and flags; a stage's own flag wins over its reason's, that over its rung's.

    With `stages` (stage_id, is_deleted) and `aliases` (stage_id, to_stage) every stage is there, mapped or not: one without a
    mapping of its own takes that of the stage it is an alias of, and group_stage is what its events are reported under.
    All of them are configured lists.
    """
    r = rungs.select(F.col("code").alias("rung"), "depth", F.col("attempt").alias("_a"), F.col("connected").alias("_c"), "interested")
    q = reasons.select(F.col("code").alias("reason"), F.col("attempt").alias("_ra"), F.col("connected").alias("_rc"))
    extra = []
    if stages is not None:
        a = aliases.select(F.col("stage_id").alias("_s"), "to_stage")
        m = stage_map.select(F.col("stage_id").alias("_m"), *[c for c in stage_map.columns if c != "stage_id"])
        own = stage_map.select(F.col("stage_id").alias("_own"), F.lit(True).alias("_has"))
        rows = stages.join(F.broadcast(a), F.col("stage_id") == a["_s"], "left").join(F.broadcast(own), F.col("stage_id") == own["_own"], "left")
        rows = rows.withColumn("_by", F.when(F.col("_has"), F.col("stage_id")).otherwise(F.col("to_stage"))).join(F.broadcast(m), F.col("_by") == m["_m"], "left")
        stage_map = rows.withColumns({"group_stage": F.coalesce("to_stage", "stage_id"), "is_mapped": F.col("_m").isNotNull(), "via_alias": F.col("to_stage")})
        extra = ["is_deleted", "group_stage", "is_mapped", "via_alias"]
    joined = stage_map.join(F.broadcast(r), "rung", "left").join(F.broadcast(q), "reason", "left")
    return joined.select("stage_id", "rung", "reason", "depth_reached", "depth", F.coalesce("own_attempt", "_ra", "_a", F.lit(False)).alias("attempt"), F.coalesce("_rc", "_c", F.lit(False)).alias("connected"), F.coalesce("interested", F.lit(False)).alias("interested"), *extra)


def enrich(events: DataFrame, stages: DataFrame) -> DataFrame:
    """events with their stage's rung, UNMAPPED if there is none, reason, depth and flags. The stages are a configured list."""
    joined = events.join(F.broadcast(stages), "stage_id", "left")
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("attempt", "connected", "interested")}
    return joined.withColumns({"rung": F.coalesce("rung", F.lit("UNMAPPED")), **flags})


def entries(events: DataFrame, keys: list[str]) -> DataFrame:
    """Entries by the keys, each counted anew there: entries of a rung aren't the sum of its stages'.

    An entry is a distinct pair of deal and actor, human or automatic, where no actor is a value too. Pairs are made distinct
    first, summed by deal, and then by key, so that one row a pair is shuffled, whatever is counted of it.
    """
    pairs = events.select(*keys, "deal_id", "actor", "is_human").distinct()
    by_deal = pairs.groupBy(*keys, "deal_id").agg(F.count_if("is_human").alias("_h"), F.count_if(~F.col("is_human")).alias("_a"))
    human, auto = F.sum("_h"), F.sum("_a")
    return by_deal.groupBy(*keys).agg(human.alias("entries_human"), auto.alias("entries_auto"), (human + auto).alias("entries_total"), F.count_if(F.col("_h") > 0).alias("deals_human"), F.count("*").alias("deals_all"))


def cells(enriched: DataFrame) -> DataFrame:
    """funnel (a pipeline or ALL), level (c rung, s stage, r reason), key, ist_day: entries, counted anew at each."""
    funnels = F.array(F.col("pipeline_id").cast("string"), F.lit("ALL"))
    levels = F.array(F.struct(F.lit("c").alias("level"), F.col("rung").alias("key")), F.struct(F.lit("s").alias("level"), F.col("stage_id").alias("key")), F.struct(F.lit("r").alias("level"), F.col("reason").alias("key")))
    dealt = enriched.select("deal_id", "actor", "is_human", "ist_day", F.explode(funnels).alias("funnel"), levels.alias("levels"))
    dealt = dealt.select("deal_id", "actor", "is_human", "ist_day", "funnel", F.explode("levels").alias("l")).select("*", "l.level", "l.key").filter("key IS NOT NULL")
    return entries(dealt, ["funnel", "level", "key", "ist_day"])


def stage_dwell(events: DataFrame) -> DataFrame:
    """Hours from each entry to the deal's next, to three places."""
    w = Window.partitionBy("deal_id").orderBy("entered_at", "event_id")
    rows = events.withColumn("left_at", F.lead("entered_at").over(w))
    seconds = F.timestamp_diff("SECOND", F.col("entered_at"), F.col("left_at"))
    hours = F.floor((seconds * 10 + 18) / 36) / 1000.0  # whole numbers first, so that halves always go up
    return rows.select("event_id", "deal_id", "stage_id", hours.alias("hours"))


def state_drift(events: DataFrame, deals: DataFrame) -> DataFrame:
    """Deals whose row is not in the stage of their newest event."""
    newest = events.groupBy("deal_id").agg(F.max_by("stage_id", F.struct("entered_at", "event_id")).alias("event_stage"))
    return deals.join(newest, "deal_id").filter(~F.col("stage_id").eqNullSafe(F.col("event_stage"))).select("deal_id", F.col("stage_id").alias("deal_stage"), "event_stage")


def transitions(events: DataFrame) -> DataFrame:
    """Entries with the stage before; one that repeats the pipeline and stage of the entry before it is skipped."""
    w = Window.partitionBy("deal_id").orderBy("entered_at", "event_id")
    at = F.struct("pipeline_id", "stage_id")
    rows = events.withColumn("_before", F.lag(at).over(w)).filter(~F.col("_before").eqNullSafe(at))
    return rows.select("event_id", "deal_id", F.col("_before.stage_id").alias("from_stage"), F.col("stage_id").alias("to_stage"))


def first_events(events: DataFrame) -> DataFrame:
    """The first event of each deal, by time, then id."""
    first = F.min_by(F.struct("event_id", "ist_day", "stage_id", "pipeline_id", "actor"), F.struct("entered_at", "event_id"))
    return events.groupBy("deal_id").agg(first.alias("f")).select("deal_id", "f.*")


def cohort(events: DataFrame, deals: DataFrame, start: str, migration: str) -> DataFrame:
    """deal_id, joined_day, in_scope: joined from `start` on, and not on the migration day with an unknown or earlier creation."""
    joined = events.groupBy("deal_id").agg(F.min("ist_day").alias("joined_day"))
    moved = (F.col("joined_day") == F.lit(migration).cast("date")) & F.coalesce(F.col("created_day") < F.col("joined_day"), F.lit(True))
    return joined.join(deals.select("deal_id", "created_day"), "deal_id").select("deal_id", "joined_day", ((F.col("joined_day") >= F.lit(start).cast("date")) & ~moved).alias("in_scope"))


def near_duplicates(events: DataFrame, unit: str = "second") -> DataFrame:
    """Deal, pipeline and stage with several events in one unit of time, with their distinct origins and first event: the same move brought in twice."""
    at = F.date_trunc(unit, "entered_at")
    rows = events.groupBy("deal_id", "pipeline_id", "stage_id", at.alias("same")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"), F.min("event_id").alias("first_event"))
    return rows.filter("n > 1")


def stage_occupancy(stages: DataFrame, deals: DataFrame) -> DataFrame:
    """Deals that aren't archived in each stage, the empty ones too."""
    live = deals.filter(~F.col("is_archived")).groupBy("stage_id").agg(F.count("*").alias("n"))
    return stages.select("stage_id").join(live, "stage_id", "left").select("stage_id", F.coalesce("n", F.lit(0)).alias("deals"))


def occupancy_series(enriched: DataFrame, days: DataFrame, deals: DataFrame) -> DataFrame:
    """rung, day, deals: where each deal stood at the end of each day, its last event up to it, until it is archived; deals archived on an unknown day never count.

    Only the last event of a deal's day counts, and holds until the day before the deal's next one; holding periods become
    +1 and -1 steps, summed by rung over the days, so nothing is multiplied by the length of the calendar.
    """
    there = deals.filter(~F.col("is_archived") | F.col("archived_day").isNotNull()).select("deal_id", "archived_day")
    last = enriched.groupBy("deal_id", "ist_day").agg(F.max_by("rung", F.struct("entered_at", "event_id")).alias("rung"))
    held = last.withColumn("next", F.lead("ist_day").over(Window.partitionBy("deal_id").orderBy("ist_day"))).join(there, "deal_id")
    held = held.withColumn("until", F.least("next", "archived_day")).filter("until IS NULL OR until > ist_day")
    steps = held.select("rung", F.col("ist_day"), F.lit(1).alias("step")).union(held.filter("until IS NOT NULL").select("rung", F.col("until"), F.lit(-1)))
    daily = steps.groupBy("rung", "ist_day").agg(F.sum("step").alias("step"))
    grid = enriched.select("rung").distinct().crossJoin(F.broadcast(days))  # rungs x days: both are short lists
    w = Window.partitionBy("rung").orderBy("ist_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return grid.join(daily, ["rung", "ist_day"], "left").select("rung", "ist_day", F.sum(F.coalesce("step", F.lit(0))).over(w).alias("deals"))


def reach(enriched: DataFrame) -> DataFrame:
    """First and last day and number of events of each deal in each rung."""
    return enriched.groupBy("deal_id", "rung").agg(F.min("ist_day").alias("first_day"), F.max("ist_day").alias("last_day"), F.count("*").alias("events"))
