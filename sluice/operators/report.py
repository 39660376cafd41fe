"""The funnel report's tables: rungs, stages, reasons, owners, daily facts, coverage, and how changes are shown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.metrics import day, within


def counts_now(deals: DataFrame, stages: DataFrame, keys: list[str]) -> DataFrame:
    """pipeline_id, keys, deals: deals that aren't archived by a stage's rung and reason, those of no deals too; UNMAPPED is a rung. A deleted stage shows while a deal is in it."""
    live = deals.filter("NOT is_archived").groupBy("pipeline_id", "stage_id").agg(F.count("*").alias("n"))
    places = deals.select("pipeline_id").distinct().join(F.broadcast(stages), how="cross")  # configured lists, both short
    rows = places.join(live, ["pipeline_id", "stage_id"], "left").filter(~F.col("is_deleted") | F.col("n").isNotNull())
    rows = rows.withColumns({"rung": F.coalesce("rung", F.lit("UNMAPPED")), "reason": F.coalesce("reason", F.lit(""))})
    return rows.groupBy("pipeline_id", *keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deals"))


def coverage(days: DataFrame, store_start: Column, syncs: DataFrame, d: str) -> DataFrame:
    """ist_day, covered: whether the store had begun by the day and every account was synced on it or later, up to d. syncs: account, synced_day."""
    oldest = syncs.agg(F.min("synced_day").alias("_end"), F.count("*").alias("_n"))
    ok = (F.col("ist_day") >= store_start) & (F.col("ist_day") <= F.col("_end")) & (F.col("ist_day") <= day(d))
    return days.join(F.broadcast(oldest)).select("ist_day", F.coalesce(ok, F.lit(False)).alias("covered"))  # one row of bounds


def windows(entered: DataFrame, keys: list[str], d: str) -> DataFrame:
    """keys, today, yesterday, roll7, prev7, inception of entries: distinct pairs of deal and actor day by day, and distinct deals up to d."""
    pairs = entered.filter(F.col("ist_day") <= day(d)).select(*keys, "deal_id", "actor", "is_human", "ist_day").distinct()
    by_deal = pairs.groupBy(*keys, "deal_id").agg(*[F.count_if(within(d, *w)).alias(n) for n, w in (("today", (0, 0)), ("yesterday", (1, 1)), ("roll7", (6, 0)), ("prev7", (13, 7)))])
    return by_deal.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("today", "yesterday", "roll7", "prev7")], F.count("*").alias("inception"))


def report_rows(entered: DataFrame, now: DataFrame, dimension: DataFrame, key: str, d: str) -> DataFrame:
    """The dimension's rows, in its order, with `now` and the windows of each, zero where there is none: rungs, native stages or reasons of a report."""
    rows = F.broadcast(dimension).join(windows(entered, [key], d), key, "left").join(now.select(key, "now"), key, "left")
    return rows.select(*dimension.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("now", "today", "yesterday", "roll7", "prev7", "inception")])


def states_at(events: DataFrame, deals: DataFrame, d: str) -> DataFrame:
    """deal_id and its place (rung, stage_id, pipeline_id) at the end of d; deals archived by then, or on an unknown day, are left out."""
    last = events.filter(F.col("ist_day") <= day(d)).groupBy("deal_id").agg(F.max_by(F.struct("rung", "reason", "stage_id", "pipeline_id"), F.struct("entered_at", "event_id")).alias("s"))
    there = deals.filter(~F.col("is_archived") | (F.col("archived_day") > day(d))).select("deal_id", "owner")
    return last.join(there, "deal_id").select("deal_id", "owner", "s.*")


def net_new(enriched: DataFrame, d: str | None = None) -> DataFrame:
    """deal_id, ist_day, actor: a deal's first human event, unless it was a bad contact by that day."""
    first = enriched.filter("is_human").groupBy("deal_id").agg(F.min_by(F.struct("ist_day", "actor"), F.struct("entered_at", "event_id")).alias("f")).select("deal_id", "f.*")
    bad = enriched.filter("reason = 'BAD_CONTACT'").groupBy("deal_id").agg(F.min("ist_day").alias("_bad"))
    rows = first.join(bad, "deal_id", "left").filter("_bad IS NULL OR _bad > ist_day").drop("_bad")
    return rows.filter(F.col("ist_day") == day(d)) if d else rows


def owner_report(enriched: DataFrame, deals: DataFrame, owner_events: DataFrame, d: str) -> DataFrame:
    """owner and what it did by d: moves and deals engaged today, deals engaged in 7 days, new deals, deals assigned today, and the deals it holds now, all, live, dead and won.

    The owner of a deal is the last one assigned up to d, else the deal's own. owner_events: deal_id, owner, assigned_at, ist_day.
    """
    human = enriched.filter(F.col("is_human") & within(d, 6, 0) & F.col("actor").isNotNull()).withColumnRenamed("actor", "owner_id")
    today = within(d, 0, 0)
    acted = human.groupBy("owner_id").agg(F.countDistinct(F.when(today, F.struct("deal_id", "stage_id"))).alias("moves"), F.countDistinct(F.when(today, F.col("deal_id"))).alias("engaged"), F.countDistinct("deal_id").alias("engaged7"))
    new = net_new(enriched, d).filter("actor IS NOT NULL").groupBy(F.col("actor").alias("owner_id")).agg(F.count("*").alias("net_new"))
    given = owner_events.filter(today & F.col("owner").isNotNull()).groupBy(F.col("owner").alias("owner_id")).agg(F.count("*").alias("assigned"))
    last = owner_events.filter(F.col("ist_day") <= day(d)).groupBy("deal_id").agg(F.max_by("owner", F.struct("assigned_at", "owner")).alias("_last"))
    held = states_at(enriched, deals, d).join(last, "deal_id", "left").withColumn("owner_id", F.coalesce("_last", "owner"))
    live = ~F.col("rung").isin("DEAD", "WON")
    held = held.groupBy("owner_id").agg(F.count("*").alias("now"), F.count_if(live).alias("live"), F.count_if(F.col("rung") == "DEAD").alias("dead"), F.count_if(F.col("rung") == "WON").alias("won"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [x.withColumn("owner_id", F.col("owner_id").cast("long")) for x in (acted, new, given, held)])
    columns = ("moves", "engaged", "engaged7", "net_new", "assigned", "now", "live", "dead", "won")
    return rows.groupBy("owner_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])  # one row of each part an owner


def funnel_facts(enriched: DataFrame, scope: DataFrame) -> DataFrame:
    """ist_day, pipeline_id, stage_id, scope (all or in_scope) with entries and deals, for all days at once. scope: deal_id of the cohort."""
    from sluice.operators.events import entries

    marked = enriched.join(scope.select("deal_id", F.lit(True).alias("_in")), "deal_id", "left")
    dealt = marked.withColumn("scope", F.explode(F.when(F.col("_in"), F.array(F.lit("all"), F.lit("in_scope"))).otherwise(F.array(F.lit("all")))))
    return entries(dealt, ["ist_day", "pipeline_id", "stage_id", "scope"])


def owner_facts(enriched: DataFrame, owner_events: DataFrame) -> DataFrame:
    """ist_day, actor, kind, code, human, auto, deals: stage entries by rung, engaged deals, new deals and assignments of every day."""
    entry = enriched.groupBy("ist_day", "actor", F.lit("stage_entry").alias("kind"), F.col("rung").alias("code")).agg(
        F.countDistinct(F.when(F.col("is_human"), F.col("deal_id"))).alias("human"), F.countDistinct(F.when(~F.col("is_human"), F.col("deal_id"))).alias("auto"), F.countDistinct("deal_id").alias("deals"))
    none = F.lit(None).cast("string")
    human = enriched.filter("is_human AND actor IS NOT NULL")
    engaged = human.groupBy("ist_day", "actor", F.lit("engaged").alias("kind"), none.alias("code")).agg(F.countDistinct("deal_id", "stage_id").alias("human"), F.lit(0).cast("long").alias("auto"), F.countDistinct("deal_id").alias("deals"))
    new = net_new(enriched).filter("actor IS NOT NULL").groupBy("ist_day", "actor", F.lit("net_new").alias("kind"), none.alias("code")).agg(F.count("*").alias("human"), F.lit(0).cast("long").alias("auto"), F.count("*").alias("deals"))
    given = owner_events.filter("owner IS NOT NULL").groupBy("ist_day", F.col("owner").alias("actor"), F.lit("assigned").alias("kind"), none.alias("code")).agg(F.lit(0).cast("long").alias("human"), F.count("*").alias("auto"), F.countDistinct("deal_id").alias("deals"))
    return reduce(DataFrame.unionByName, [x.withColumn("actor", F.col("actor").cast("long")) for x in (entry, engaged, new, given)])


def empty_days(days: DataFrame, events: DataFrame, d: str, lookback: int) -> DataFrame:
    """ist_day, weekend: the days of the last `lookback` up to d without an event."""
    seen = events.select("ist_day").distinct()
    return days.filter(within(d, lookback - 1, 0)).join(seen, "ist_day", "left_anti").select("ist_day", (F.weekday("ist_day") >= 5).alias("weekend"))


def anchors(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, expected, actual, ok of numbers that are known, and of those that nobody expected."""
    rows = expected.join(actual, key, "full")
    return rows.select(key, "expected", F.coalesce("actual", F.lit(0)).alias("actual"), F.coalesce(F.col("expected") == F.coalesce("actual", F.lit(0)), F.lit(False)).alias("ok"))


def snapshot_rows(snapshots: DataFrame, metrics: list[str]) -> DataFrame:
    """snapshot, metric, label, value of JSON objects of numbers, a column for each metric."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.from_json(F.col(m), "map<string,double>").alias("v")) for m in metrics])
    rows = snapshots.select("snapshot", F.explode(entries).alias("e")).select("snapshot", "e.metric", F.explode("e.v").alias("label", "value"))
    return rows


def vertical_report(events: DataFrame, rules: DataFrame, status: DataFrame, d: str) -> DataFrame:
    """row_name, today, roll7, roll7_days, prev7, prev7_days, engaged7, inception of rows given by exact stages or a prefix.

    A day counts a deal once; only days that are covered (status ok or partial) count in the windows, and how many there were
    is told; inception begins with a row's own day if its rule has one. status: ist_day, status. The rules are a short list.
    """
    hit = (F.col("stage_id") == F.col("stage")) | F.coalesce(F.col("stage_id").startswith(F.col("prefix")), F.lit(False))
    rows = events.filter(F.col("ist_day") <= day(d)).join(F.broadcast(rules), hit).select("row_name", "inception_from", "deal_id", "ist_day", "is_human").distinct()
    covered = status.filter(F.col("status").isin("ok", "partial")).select("ist_day", F.lit(True).alias("_c"))
    rows = rows.join(F.broadcast(covered), "ist_day", "left")  # a row a day
    once = rows.groupBy("row_name", "inception_from", "deal_id", "ist_day").agg(F.max("is_human").alias("is_human"), F.first("_c").alias("_c"))
    count = lambda first, last: F.count_if(F.coalesce("_c", F.lit(False)) & within(d, first, last))
    by_deal = once.groupBy("row_name", "inception_from", "deal_id").agg(
        F.count_if(within(d, 0, 0)).alias("today"), count(6, 0).alias("roll7"), count(13, 7).alias("prev7"), F.max(F.col("is_human") & within(d, 6, 0)).alias("_e"),
        F.max(F.col("inception_from").isNull() | (F.col("ist_day") >= F.col("inception_from"))).alias("_i"))
    out = by_deal.groupBy("row_name").agg(F.sum("today").alias("today"), F.sum("roll7").alias("roll7"), F.sum("prev7").alias("prev7"), F.count_if("_e").alias("engaged7"), F.count_if("_i").alias("inception"))
    spans = status.filter(F.col("status").isin("ok", "partial")).agg(F.count_if(within(d, 6, 0)).alias("roll7_days"), F.count_if(within(d, 13, 7)).alias("prev7_days"))
    return out.join(F.broadcast(spans))  # one row


def chip(cur: Column, prev: Column, days_cur: Column, days_prev: Column, full: int = 7) -> Column:
    """kind (up, down, flat or na), pct and per_day of a change; windows that aren't full are compared by covered day."""
    partial = (days_cur != full) | (days_prev != full)
    a, b = F.when(partial, cur * days_prev).otherwise(cur), F.when(partial, prev * days_cur).otherwise(prev)  # whole numbers, so that halves are told apart
    na = cur.isNull() | prev.isNull() | (days_cur == 0) | (days_prev == 0)
    kind = F.when(na, "na").when(a == b, "flat").when(a > b, "up").otherwise("down")
    pct = F.when(kind.isin("up", "down"), F.when(b == 0, 100).otherwise(F.abs(F.bround((a - b) * 100.0 / b, 0)).cast("int")))
    return F.struct(kind.alias("kind"), pct.alias("pct"), F.when(~na, partial).alias("per_day"))


def daily_chip(cur: Column, prev: Column, status: Column, status_before: Column) -> Column:
    """Why today's change isn't shown (partial, weekend, gap), else chip."""
    withheld = F.when(status == "partial", "partial").when(status_before == "weekend", "weekend").when((status_before == "gap") | prev.isNull(), "gap")
    one = F.lit(7)
    shown = chip(cur, prev, one, one)
    return F.struct(F.coalesce(withheld, shown["kind"]).alias("kind"), F.when(withheld.isNull(), shown["pct"]).alias("pct"))


def row_problems(rules: DataFrame, stages: DataFrame) -> DataFrame:
    """row_name, stage, problem: labels that no stage has, prefixes that match none, and labels in two rows that aren't meant to overlap."""
    known = stages.select(F.col("stage_id").alias("stage")).distinct()
    gone = rules.filter("stage IS NOT NULL").join(known, "stage", "left_anti").select("row_name", "stage", F.lit("missing").alias("problem"))
    prefixed = rules.filter("prefix IS NOT NULL")
    idle = prefixed.join(F.broadcast(known), known["stage"].startswith(prefixed["prefix"]), "left_anti").select("row_name", F.col("prefix").alias("stage"), F.lit("prefix_matches_none").alias("problem"))
    rows = rules.filter("stage IS NOT NULL").groupBy("stage").agg(F.collect_set("row_name").alias("r"), F.max("overlap").alias("o")).filter("size(r) > 1 AND NOT o")
    twice = rows.select(F.array_join(F.array_sort("r"), "+").alias("row_name"), "stage", F.lit("two_rows").alias("problem"))
    return gone.unionByName(idle).unionByName(twice)


def resolve_pipeline(events: DataFrame, stages: DataFrame, history: DataFrame, current: DataFrame) -> DataFrame:
    """event_id, pipeline, basis: the pipeline of a stage that only one has (unique_stage_id), else the deal's at the time (pipeline_history), else its present one (deal_current), where one of several has the stage; else unresolved.

    Of a stage that no pipeline has any more, the deal's pipeline at the time is taken, else its present one.

    stages: stage_id, pipeline; history: deal_id, at, pipeline; current: deal_id, pipeline. Events of unresolved rows are findings.
    """
    from sluice.functions.patterns import asof_join

    homes = stages.groupBy(F.col("stage_id").alias("_s")).agg(F.array_sort(F.collect_set("pipeline")).alias("_homes"))
    then = asof_join(events, history, "deal_id", "entered_at", "at", "pipeline", backward_fill=True).withColumnRenamed("pipeline", "_then")
    now = current.select(F.col("deal_id").alias("_d"), F.col("pipeline").alias("_now"))
    rows = then.join(F.broadcast(homes), then["stage_id"] == homes["_s"], "left").join(now, then["deal_id"] == now["_d"], "left")
    homes_n = F.coalesce(F.size("_homes"), F.lit(0))
    can = lambda c: F.col(c).isNotNull() & ((homes_n == 0) | F.coalesce(F.array_contains("_homes", F.col(c)), F.lit(False)))
    basis = F.when(homes_n == 1, "unique_stage_id").when(can("_then"), "pipeline_history").when(can("_now"), "deal_current").otherwise("unresolved")
    found = F.when(basis == "unique_stage_id", F.get("_homes", F.lit(0))).when(basis == "pipeline_history", F.col("_then")).when(basis == "deal_current", F.col("_now"))
    return rows.select("event_id", found.alias("pipeline"), basis.alias("basis"))


def lead_source_country(states: DataFrame, deals: DataFrame, rung: str, country: Column, order: list[str]) -> DataFrame:
    """place, country, lead_source, deals: deals of a rung by the country of their lead source, in the order of a list, other countries last."""
    rows = states.filter(F.col("rung") == rung).join(deals.select("deal_id", "lead_source"), "deal_id").withColumn("country", country)
    n = rows.groupBy("country", F.coalesce("lead_source", F.lit("(none)")).alias("lead_source")).agg(F.count("*").alias("deals"))
    at = F.array_position(F.array(*map(F.lit, order)), F.col("country"))
    rank = F.when(at > 0, at).otherwise(99)
    return n.withColumn("place", F.row_number().over(Window.orderBy(rank, F.col("deals").desc(), "lead_source", "country")))  # a row a source
