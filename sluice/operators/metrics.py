"""Funnel metrics as of a day, or for all days at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.patterns import rolling_distinct


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def within(d: str, first: int, last: int) -> Column:
    """ist_day lies between `first` and `last` days before d."""
    return F.col("ist_day").between(F.date_sub(day(d), first), F.date_sub(day(d), last))


def rung_entries(cells: DataFrame, enriched: DataFrame, d: str) -> DataFrame:
    """funnel ALL by rung: entries of the day, the day before, 7 days and the 7 before (sums of daily pairs), distinct deals of 7 days, inception."""
    own = cells.filter((F.col("funnel") == "ALL") & (F.col("level") == "c") & (F.col("ist_day") <= day(d)))
    total = lambda first, last: F.coalesce(F.sum(F.when(within(d, first, last), F.col("entries_total"))), F.lit(0))
    sums = own.groupBy(F.col("key").alias("rung")).agg(total(0, 0).alias("today"), total(1, 1).alias("yesterday"), total(6, 0).alias("roll7"), total(13, 7).alias("prev7"))
    seen = enriched.filter(F.col("ist_day") <= day(d)).groupBy("rung")
    unions = seen.agg(F.countDistinct(F.when(within(d, 6, 0), F.col("deal_id"))).alias("deals7"), F.countDistinct("deal_id").alias("inception"), F.countDistinct(F.when(F.col("is_human"), F.col("deal_id"))).alias("inception_human"))
    return sums.join(unions, "rung")


def inception_curve(enriched: DataFrame) -> DataFrame:
    """rung, ist_day, new, total: distinct deals ever in the rung up to each day with a new one."""
    first = enriched.groupBy("rung", "deal_id").agg(F.min("ist_day").alias("ist_day"))
    daily = first.groupBy("rung", "ist_day").agg(F.count("*").alias("new"))
    w = Window.partitionBy("rung").orderBy("ist_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total", F.sum("new").over(w))


def rolling_sums(daily: DataFrame, days: DataFrame, key: str, value: str) -> DataFrame:
    """key, ist_day, today, roll7, prev7 over a dense calendar."""
    grid = daily.select(key).distinct().crossJoin(F.broadcast(days))  # keys are rungs or stages, days a calendar
    w = Window.partitionBy(key).orderBy("ist_day")
    rows = grid.join(daily.select(key, "ist_day", value), [key, "ist_day"], "left").withColumn("today", F.coalesce(value, F.lit(0)))
    return rows.select(key, "ist_day", "today", F.sum("today").over(w.rowsBetween(-6, 0)).alias("roll7"), F.coalesce(F.sum("today").over(w.rowsBetween(-13, -7)), F.lit(0)).alias("prev7"))


def engaged(events: DataFrame, enriched: DataFrame) -> DataFrame:
    """ist_day, engaged, engaged7, engaged_prev7, net_new: deals with a human event on the day, in 7 days, in the 7 days before these, and those whose first one it is and that had no bad contact up to it."""
    human = events.filter("is_human")
    daily = human.groupBy("ist_day").agg(F.countDistinct("deal_id").alias("engaged"))
    seven = rolling_distinct(human, [], "deal_id", "ist_day", 7).withColumnRenamed("n", "engaged7")
    before = seven.select(F.date_add("ist_day", 7).alias("ist_day"), F.col("engaged7").alias("engaged_prev7"))
    first = human.groupBy("deal_id").agg(F.min("ist_day").alias("ist_day"))
    bad = enriched.filter("reason = 'BAD_CONTACT'").groupBy("deal_id").agg(F.min("ist_day").alias("bad_day"))
    new = first.join(bad, "deal_id", "left").filter("bad_day IS NULL OR bad_day > ist_day").groupBy("ist_day").agg(F.count("*").alias("net_new"))
    rows = daily.join(seven, "ist_day").join(before, "ist_day", "left").join(new, "ist_day", "left")
    return rows.select("ist_day", "engaged", "engaged7", F.coalesce("engaged_prev7", F.lit(0)).alias("engaged_prev7"), F.coalesce("net_new", F.lit(0)).alias("net_new"))


def leads_assigned(enriched: DataFrame) -> DataFrame:
    """ist_day, sourced, new_deals: entries to SOURCED, and deals whose first event it is."""
    sourced = enriched.filter("rung = 'SOURCED'").groupBy("ist_day").agg(F.countDistinct(F.struct("deal_id", "actor", "is_human")).alias("sourced"))
    new = enriched.groupBy("deal_id").agg(F.min("ist_day").alias("ist_day")).groupBy("ist_day").agg(F.count("*").alias("new_deals"))
    return new.join(sourced, "ist_day", "full").select("ist_day", F.coalesce("sourced", F.lit(0)).alias("sourced"), F.coalesce("new_deals", F.lit(0)).alias("new_deals"))


def occupancy_at(enriched: DataFrame, deals: DataFrame, d: str) -> DataFrame:
    """state, rung, reason, deals: the live, dead, won and unmapped deals at the end of day d; deals archived by then, or on an unknown day, are left out."""
    last = enriched.filter(F.col("ist_day") <= day(d)).groupBy("deal_id").agg(F.max_by(F.struct("rung", "reason"), F.struct("entered_at", "event_id")).alias("s"))
    there = deals.filter(~F.col("is_archived") | (F.col("archived_day") > day(d))).select("deal_id")
    live = last.join(there, "deal_id", "left_semi").select("s.rung", "s.reason")
    state = F.when(F.col("rung") == "UNMAPPED", "unmapped").when(F.col("rung") == "DEAD", "dead").when(F.col("rung") == "WON", "won").otherwise("live")
    return live.groupBy(state.alias("state"), "rung", "reason").agg(F.count("*").alias("deals"))


def derived_rungs(enriched: DataFrame, held_reasons: tuple[str, ...]) -> DataFrame:
    """deal_id, rung, credit_day, evidence_day: rungs that no stage stands for.

    MEETING_HELD: the first MEETING_BOOKED, then the first later event that is a live rung of depth 6 or more, or a death of
    one of these reasons at depth 5 or more; void if the deal was a no-show or cancelled up to the evidence; credited to the
    booking. EVALUATED: the first ASSET_RECEIVED, then the first later death at depth 8 or more or live rung of depth 9 or
    more; credited to that. Two passes of conditional minima over each deal's events, by time and id.
    """
    at = F.struct("entered_at", "event_id", "ist_day")
    anchors = enriched.groupBy("deal_id").agg(
        F.min(F.when(F.col("rung") == "MEETING_BOOKED", at)).alias("booked"), F.min(F.when(F.col("rung") == "ASSET_RECEIVED", at)).alias("received"),
        F.min(F.when(F.col("reason").isin("NO_SHOW", "MEETING_CANCELLED"), F.col("ist_day"))).alias("bad_day"),
    ).filter("booked IS NOT NULL OR received IS NOT NULL")
    live = ~F.col("rung").isin("DEAD", "UNMAPPED")
    died = lambda depth: (F.col("rung") == "DEAD") & (F.coalesce("depth_reached", F.lit(0.0)) >= depth)
    held = (F.col("booked") < at) & ((live & (F.col("depth") >= 6)) | (died(5) & F.col("reason").isin(*held_reasons)))
    evaluated = (F.col("received") < at) & (died(8) | (live & (F.col("depth") >= 9)))
    found = enriched.join(anchors, "deal_id").groupBy("deal_id").agg(F.first("booked").alias("booked"), F.first("bad_day").alias("bad_day"), F.min(F.when(held, at)).alias("held"), F.min(F.when(evaluated, at)).alias("evaluated"))
    one = found.filter("held IS NOT NULL AND (bad_day IS NULL OR bad_day > held.ist_day)").select("deal_id", F.lit("MEETING_HELD").alias("rung"), F.col("booked.ist_day").alias("credit_day"), F.col("held.ist_day").alias("evidence_day"))
    two = found.filter("evaluated IS NOT NULL").select("deal_id", F.lit("EVALUATED").alias("rung"), F.col("evaluated.ist_day").alias("credit_day"), F.col("evaluated.ist_day").alias("evidence_day"))
    return one.unionByName(two)


def dead_breakdown(enriched: DataFrame, deals: DataFrame, d: str) -> DataFrame:
    """Reason by reason: deals dead now, entries today and in 7 days, deals ever."""
    seen = enriched.filter(F.col("reason").isNotNull() & (F.col("ist_day") <= day(d)))
    pair = F.struct("deal_id", "actor", "is_human", "ist_day")
    counts = seen.groupBy("reason").agg(F.countDistinct(F.when(within(d, 0, 0), pair)).alias("today"), F.countDistinct(F.when(within(d, 6, 0), pair)).alias("roll7"), F.countDistinct("deal_id").alias("inception"))
    now = occupancy_at(enriched, deals, d).filter("reason IS NOT NULL").groupBy("reason").agg(F.sum("deals").alias("now"))
    return counts.join(now, "reason", "left").withColumn("now", F.coalesce("now", F.lit(0)))


def owner_rows(events: DataFrame, d: str) -> DataFrame:
    """By actor: moves today, deals engaged today and in 7 days."""
    human = events.filter(F.col("is_human") & (F.col("ist_day") <= day(d)))
    return human.groupBy("actor").agg(F.count_if(within(d, 0, 0)).alias("moves"), F.countDistinct(F.when(within(d, 0, 0), F.col("deal_id"))).alias("engaged"), F.countDistinct(F.when(within(d, 6, 0), F.col("deal_id"))).alias("engaged7"))


def matrix(enriched: DataFrame, pipelines: list[int]) -> DataFrame:
    """rung by pipeline: distinct deals ever."""
    wide = enriched.groupBy("rung").pivot("pipeline_id", pipelines).agg(F.countDistinct("deal_id"))
    return wide.select("rung", *[F.coalesce(F.col(str(p)), F.lit(0)).alias(f"p{p}") for p in pipelines])


def daily_facts(enriched: DataFrame) -> DataFrame:
    """ist_day, pipeline, deals: engaged deals, each in the pipeline of its last human event of the day."""
    last = enriched.filter("is_human").groupBy("deal_id", "ist_day").agg(F.max_by("pipeline_id", F.struct("entered_at", "event_id")).alias("pipeline_id"))
    return last.groupBy("ist_day", "pipeline_id").agg(F.count("*").alias("deals"))


def effort_entries(enriched: DataFrame) -> DataFrame:
    """By day: entries to stages that count as attempted, connected, interested."""
    pair = F.struct("deal_id", "actor", "is_human")
    return enriched.groupBy("ist_day").agg(*[F.countDistinct(F.when(F.col(flag), pair)).alias(name) for flag, name in (("attempt", "attempted"), ("connected", "connected"), ("interested", "interested"))])


def deals_entered(enriched: DataFrame, d: str) -> DataFrame:
    """funnel (a pipeline, or ALL), level (c rung, s native stage, r reason), key: distinct deals, all and human, today and in 7 days.

    Each (deal, key) is brought together once, with what it counts for, before its two funnels and the keys are counted.
    """
    keys = F.array(*[F.struct(F.lit(level).alias("level"), F.col(c).alias("key")) for level, c in (("c", "rung"), ("s", "stage_id"), ("r", "reason"))])
    seen = enriched.filter(within(d, 6, 0)).select("deal_id", "pipeline_id", "is_human", within(d, 0, 0).alias("_today"), F.explode(keys).alias("k")).filter("k.key IS NOT NULL")
    funnels = seen.withColumn("funnel", F.explode(F.array(F.col("pipeline_id").cast("string"), F.lit("ALL"))))
    once = funnels.groupBy("funnel", "k.level", "k.key", "deal_id").agg(F.max("_today").alias("today"), F.max(F.col("_today") & F.col("is_human")).alias("today_human"), F.max("is_human").alias("roll7_human"))
    return once.groupBy("funnel", "level", "key").agg(F.count_if("today").alias("today"), F.count_if("today_human").alias("today_human"), F.count("*").alias("roll7"), F.count_if("roll7_human").alias("roll7_human"))


def owner_stages(deals: DataFrame, d: str) -> DataFrame:
    """snapshot_day, account_id, pipeline_id, owner, stage_id, deals: live deals by owner and stage, as of now, under day d; to be written in place of that day's (files.write_days)."""
    keys = ("account_id", "pipeline_id", "owner", "stage_id")
    return deals.filter(~F.col("is_archived")).groupBy(*keys).agg(F.count("*").alias("deals")).select(day(d).alias("snapshot_day"), *keys, "deals")


def day_status(events: DataFrame, days: DataFrame, d: str, *, complete: bool = True, share: float = 0.05, lookback: int = 14) -> DataFrame:
    """ist_day, total, status of each of the days: partial (d, if it isn't complete), weekend (without events), gap or ok.

    A gap is a weekday with fewer events than `share` of the median of the weekdays with events in the `lookback` days before d.
    """
    totals = days.join(events.groupBy("ist_day").agg(F.count("*").alias("n")), "ist_day", "left").withColumn("total", F.coalesce("n", F.lit(0)))
    weekend = F.weekday("ist_day") >= 5
    counted = events.groupBy("ist_day").agg(F.count("*").alias("n")).filter(within(d, lookback, 1) & ~weekend)
    base = counted.agg(F.coalesce(F.percentile("n", F.lit(0.5)), F.lit(0.0)).alias("base"))
    status = F.when((F.col("ist_day") == day(d)) & F.lit(not complete), "partial").when(weekend, F.when(F.col("total") == 0, "weekend").otherwise("ok"))
    status = status.when((F.col("base") > 0) & (F.col("total") < F.col("base") * share), "gap").otherwise("ok")
    return totals.join(F.broadcast(base)).select("ist_day", "total", status.alias("status"))  # base is one row


def vertical_rows(events: DataFrame, rules: DataFrame, d: str) -> DataFrame:
    """row_name, today, roll7, prev7, inception of rows given by exact stages or a prefix; a stage may be in several rows."""
    hit = (rules["stage"] == events["stage_id"]) | F.col("stage_id").startswith(F.col("prefix"))
    rows = events.filter(F.col("ist_day") <= day(d)).join(F.broadcast(rules), hit)
    pick = lambda first, last: F.countDistinct(F.when(within(d, first, last), F.struct("deal_id", "ist_day")))
    return rows.groupBy("row_name").agg(pick(0, 0).alias("today"), pick(6, 0).alias("roll7"), pick(13, 7).alias("prev7"), F.countDistinct("deal_id").alias("inception"))


def crosscheck(events: DataFrame, snapshot: DataFrame, cutoffs: list[int]) -> DataFrame:
    """ist_day, old, new, delta, hypothesis: a snapshot's daily deal counts against recomputed ones, with the first hypothesis that gives the old value.

    Hypotheses, in order of complexity: the day as reported, or cut `minutes` later or earlier; all events, or human ones.
    """
    dealt = events.withColumn("h", F.explode(F.array(*[F.struct(F.lit(2 * i + j).alias("rank"), F.lit(m).alias("minutes"), F.lit(bool(j)).alias("human_only")) for i, m in enumerate(cutoffs) for j in (0, 1)])))
    dealt = dealt.filter(~F.col("h.human_only") | F.col("is_human")).withColumn("ist_day", F.expr("cast(timestampadd(MINUTE, h.minutes, entered_at) as date)"))
    values = dealt.groupBy("ist_day", "h.rank").agg(F.countDistinct("deal_id").alias("value"))
    joined = snapshot.join(values, "ist_day", "left").groupBy("ist_day", "old")
    found = joined.agg(F.max(F.when(F.col("rank") == 0, F.col("value"))).alias("new"), F.min(F.when(F.col("value") == F.col("old"), F.col("rank"))).alias("hypothesis"))
    return found.select("ist_day", "old", F.coalesce("new", F.lit(0)).alias("new"), (F.coalesce("new", F.lit(0)) - F.col("old")).alias("delta"), "hypothesis")


@dataclass(frozen=True)
class Frames:
    """What the metrics are worked out from: events, the same with their rungs, deals, deal_id and in_scope of the cohort, and the deaths that count as a held meeting."""

    events: DataFrame
    enriched: DataFrame
    deals: DataFrame
    cohort: DataFrame
    held_reasons: tuple[str, ...]


def _deals(rows: DataFrame, key: str = "rung") -> DataFrame:
    return rows.groupBy(F.col(key).alias("key")).agg(F.countDistinct("deal_id").alias("value"))


def _entries(rows: DataFrame, d: str) -> DataFrame:
    """Entries of 7 days by rung, each (deal, actor, kind) once a day."""
    return rows.filter(within(d, 6, 0)).groupBy(F.col("rung").alias("key")).agg(F.countDistinct(F.struct("deal_id", "actor", "is_human", "ist_day")).alias("value"))


def _named(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.cast("long").alias("value"))


def _on_day(rows: DataFrame, d: str, *columns: str) -> DataFrame:
    """The columns' values of day d, by name, 0 if there is no row."""
    one = rows.filter(F.col("ist_day") == day(d)).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[_named(c, F.col(c)) for c in columns])))


def _engaged(first: int) -> Callable[[Frames, str], DataFrame]:
    return lambda f, d: f.events.filter(F.col("is_human") & within(d, first, 0)).agg(F.countDistinct("deal_id").alias("value")).select(F.lit("engaged").alias("key"), "value")


def _derived(rung: str) -> Callable[[Frames, str], DataFrame]:
    def of(f: Frames, d: str) -> DataFrame:
        found = derived_rungs(f.enriched, f.held_reasons).filter((F.col("rung") == rung) & (F.col("evidence_day") <= day(d)))
        return found.agg(F.count("*").alias("value")).select(F.lit(rung).alias("key"), "value")

    return of


def _seen(f: Frames, d: str) -> DataFrame:
    return f.enriched.filter(F.col("ist_day") <= day(d))


#: The metric dictionary: by name, (key, value) of a day over all funnels.
METRICS: dict[str, Callable[[Frames, str], DataFrame]] = {
    "stage_entries": lambda f, d: _entries(f.enriched, d),
    "deals_entered": lambda f, d: _deals(f.enriched.filter(within(d, 6, 0))),
    "inception": lambda f, d: _deals(_seen(f, d)),
    "inception_in_scope": lambda f, d: _deals(_seen(f, d).join(f.cohort.filter("in_scope").select(F.col("deal_id").alias("_d")), F.col("deal_id") == F.col("_d"), "left_semi")),
    "leads_assigned": lambda f, d: _on_day(leads_assigned(f.enriched), d, "sourced", "new_deals"),
    "engaged_daily": _engaged(0),
    "engaged_7d": _engaged(6),
    "net_new_engaged": lambda f, d: _on_day(engaged(f.events, f.enriched), d, "net_new"),
    "occupancy_now": lambda f, d: occupancy_at(f.enriched, f.deals, d).groupBy(F.col("state").alias("key")).agg(F.sum("deals").alias("value")),
    "dead_by_reason": lambda f, d: dead_breakdown(f.enriched, f.deals, d).select(F.col("reason").alias("key"), F.col("now").alias("value")),
    "meeting_held": _derived("MEETING_HELD"),
    "evaluated": _derived("EVALUATED"),
    "won_to_date": lambda f, d: _deals(_seen(f, d).filter("rung = 'WON'")),
    "contracts_signed_7d": lambda f, d: _entries(f.enriched.filter("rung = 'CONTRACT' AND is_human"), d),
}


def metric_values(f: Frames, d: str, names: list[str] | None = None) -> DataFrame:
    """metric, key, value of the dictionary's metrics, or of those that are named, at the end of day d."""
    rows = [METRICS[n](f, d).select(F.lit(n).alias("metric"), "key", F.col("value").cast("long").alias("value")) for n in names or METRICS]
    return reduce(DataFrame.unionByName, rows)
