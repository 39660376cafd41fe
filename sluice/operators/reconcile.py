"""Reconciliation of reported numbers with recomputed ones: by hypothesis, as bit masks over what counts."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.patterns import IST_MINUTES

#: Minutes of the reporting day at which a report may have been written.
CUTOFFS = (1110, 1170, 1230)
SWITCHES = ("deal_owner", "raw", "archived_excl", "utc")


@dataclass(frozen=True)
class Hypothesis:
    """How a reported number may have been counted: up to a minute of the day, for the deal's owner in place of the actor, by entries, without archived deals, without the hours before UTC midnight."""

    cutoff: int | None = None
    switches: tuple[str, ...] = ()

    def name(self) -> str:
        return "+".join([*([f"cutoff_{self.cutoff // 60:02d}{self.cutoff % 60:02d}"] if self.cutoff else []), *self.switches]) or "match"


def flow_hypotheses() -> list[Hypothesis]:
    """All combinations, the simplest first, a switch before a cut-off; the first is the number as it should be. There are 64, a bit of a long each."""
    every = [Hypothesis(c, s) for c in (None, *CUTOFFS) for r in range(len(SWITCHES) + 1) for s in itertools.combinations(SWITCHES, r)]
    return sorted(every, key=lambda h: (len(h.switches) + (h.cutoff is not None), h.cutoff is not None))


FLOW = flow_hypotheses()


def _mask(holds) -> int:
    """The bits of the hypotheses for which it holds, as a signed long."""
    bits = sum(1 << i for i, h in enumerate(FLOW) if holds(h))
    return bits - (1 << 64) if bits >> 63 else bits


def _bit(mask: Column, i: int) -> Column:
    return F.getbit(mask, F.lit(i)).cast("long")


def flow_masks(events: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """row_id, deal_id, key, mask of every event that counts for a reported number under some hypothesis: bit i says that it does under FLOW[i].

    events: deal_id, ist_day, entered_at, stage, actor, deal_owner (as of the day), is_archived, is_human. rows: row_id, ist_day, owner
    (null: all), any_source; groups: row_id, stage. Each condition of an event permits the hypotheses of a constant mask, and the
    masks are ANDed; so nothing is multiplied by the hypotheses. key is what counts once unless entries are counted.
    """
    wanted = groups.join(rows.select("row_id", F.col("ist_day").alias("_day"), "owner", "any_source"), "row_id").withColumnRenamed("stage", "_stage")
    met = events.join(F.broadcast(wanted), (events["ist_day"] == wanted["_day"]) & (events["stage"] == wanted["_stage"]))  # numbers of a few snapshots
    minute = F.pmod(F.hour("entered_at") * 60 + F.minute("entered_at") + IST_MINUTES, F.lit(1440))
    without = lambda s: F.lit(_mask(lambda h: s not in h.switches))
    every = F.lit(-1).cast("long")
    cut = F.lit(_mask(lambda h: h.cutoff is None))
    for c in CUTOFFS:
        cut = cut.bitwiseOR(F.when(minute < c, F.lit(_mask(lambda h, c=c: h.cutoff == c))).otherwise(F.lit(0)).cast("long"))
    utc = F.when(minute < IST_MINUTES, without("utc")).otherwise(every)
    archived = F.when(F.col("is_archived"), without("archived_excl")).otherwise(every)
    of = lambda c, mask: F.when(F.col(c).eqNullSafe(F.col("owner")), mask).otherwise(F.lit(0)).cast("long")
    owner = F.when(F.col("owner").isNull(), without("deal_owner")).otherwise(of("actor", without("deal_owner")).bitwiseOR(of("deal_owner", F.lit(_mask(lambda h: "deal_owner" in h.switches)))))
    mask = cut.bitwiseAND(utc).bitwiseAND(archived).bitwiseAND(owner)
    counted = met.filter(F.col("is_human") | F.col("any_source"))
    return counted.select("row_id", "deal_id", F.struct("deal_id", "stage", "actor", "is_human").alias("key"), mask.alias("mask")).filter("mask <> 0")


def flow_check(rows: DataFrame, groups: DataFrame, masks: DataFrame) -> DataFrame:
    """row_id, old, new, delta, reason, hypothesis (its bit) of reported numbers `old`: match, else the first hypothesis that gives the old number, else unexplained, or unknown_label without a stage."""
    raw = [i for i, h in enumerate(FLOW) if "raw" in h.switches]
    entries = masks.groupBy("row_id").agg(*[F.sum(_bit(F.col("mask"), i)).alias(f"v{i}") for i in raw])
    once = masks.groupBy("row_id", "key").agg(F.bit_or("mask").alias("mask"))
    once = once.groupBy("row_id").agg(*[F.sum(_bit(F.col("mask"), i)).alias(f"v{i}") for i in range(len(FLOW)) if i not in raw])
    met = rows.join(once, "row_id", "left").join(entries, "row_id", "left").join(groups.select("row_id").distinct().withColumn("_known", F.lit(True)), "row_id", "left")
    value = lambda i: F.coalesce(F.col(f"v{i}"), F.lit(0))
    found = F.coalesce(*[F.when((value(i) == F.col("old")) & (F.lit("deal_owner" not in h.switches) | F.col("owner").isNotNull()), i) for i, h in enumerate(FLOW)])
    names = F.array(*[F.lit(h.name()) for h in FLOW])
    reason = F.when(F.col("_known").isNull(), "unknown_label").otherwise(F.coalesce(F.get(names, found), F.lit("unexplained")))
    new = F.when(F.col("_known"), value(0))
    return met.select("row_id", "old", new.alias("new"), (new - F.col("old")).alias("delta"), reason.alias("reason"), F.when(F.col("_known"), found).alias("hypothesis"))


def explaining_deals(checked: DataFrame, masks: DataFrame) -> DataFrame:
    """row_id, deal_id, side: the deals that a hypothesis takes into the old number (only_old) or leaves out of it (only_new), for numbers that one explains."""
    told = checked.filter("hypothesis > 0").select(F.col("row_id").alias("_r"), "hypothesis")
    deals = masks.groupBy("row_id", "deal_id").agg(F.bit_or("mask").alias("mask"))
    met = deals.join(told, deals["row_id"] == told["_r"])
    new, old = F.getbit("mask", F.lit(0)), F.getbit(F.col("mask"), F.col("hypothesis"))
    return met.filter(new != old).select("row_id", "deal_id", F.when(new == 1, "only_new").otherwise("only_old").alias("side"))


STATES = ("match", *[f"cutoff_{c // 60:02d}{c % 60:02d}" for c in CUTOFFS], "current_owner")


def state_values(events: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """row_id, v0 to v4: how many deals stand in a row's stages at the end of its day, counted in each of the ways of STATES.

    events: deal_id, event_id, ist_day, entered_at, stage, deal_owner (as of the day), owner_now, is_archived, archived_day. A deal's last
    event, by day and cut-off, is one aggregation over the days that are asked for; its stages then meet the numbers.
    """
    days = rows.select(F.col("ist_day").alias("_day")).distinct()  # those of a few snapshots
    seen = events.join(F.broadcast(days), events["ist_day"] <= days["_day"])
    minute = F.pmod(F.hour("entered_at") * 60 + F.minute("entered_at") + IST_MINUTES, F.lit(1440))
    at = F.struct("entered_at", "event_id")
    last = [F.max_by("stage", at).alias("s0"), *[F.max_by("stage", F.when((F.col("ist_day") < F.col("_day")) | (minute < c), at)).alias(f"s{i + 1}") for i, c in enumerate(CUTOFFS)]]
    ends = seen.groupBy("deal_id", "_day").agg(*last, F.max_by("deal_owner", at).alias("_owner"), F.max("owner_now").alias("_now"), F.bool_or("is_archived").alias("_archived"), F.max("archived_day").alias("_until"))
    ends = ends.filter(~F.col("_archived") | (F.col("_until") > F.col("_day")))
    dealt = ends.select("deal_id", "_day", "_owner", "_now", F.posexplode(F.array("s0", *[f"s{i + 1}" for i in range(len(CUTOFFS))])).alias("_i", "_stage")).filter("_stage IS NOT NULL")
    wanted = groups.join(rows.select("row_id", F.col("ist_day").alias("_d"), "owner"), "row_id")
    met = dealt.join(F.broadcast(wanted), (dealt["_day"] == wanted["_d"]) & (dealt["_stage"] == wanted["stage"]))
    mine = F.col("owner").isNull() | F.col("_owner").eqNullSafe(F.col("owner"))
    bits = F.when(mine, F.expr("shiftleft(1, _i)")).otherwise(0).bitwiseOR(F.when((F.col("_i") == 0) & F.col("_now").eqNullSafe(F.col("owner")), 1 << len(CUTOFFS) + 1).otherwise(0))
    sums = met.groupBy("row_id", "deal_id").agg(F.bit_or(bits).alias("mask")).groupBy("row_id").agg(*[F.sum(_bit(F.col("mask"), i)).alias(f"v{i}") for i in range(len(STATES))])
    return rows.select("row_id").join(sums, "row_id", "left").select("row_id", *[F.coalesce(F.col(f"v{i}"), F.lit(0)).alias(f"v{i}") for i in range(len(STATES))])


def state_check(rows: DataFrame, values: DataFrame) -> DataFrame:
    """row_id, old, new, delta, reason of reported numbers of deals that stand in some stages, held against state_values: match, cut off in the day, the present owner in place of the day's, or unexplained."""
    found = rows.join(values, "row_id")
    reason = F.coalesce(*[F.when((F.col(f"v{i}") == F.col("old")) & (F.lit(name != "current_owner") | F.col("owner").isNotNull()), name) for i, name in enumerate(STATES)], F.lit("unexplained"))
    return found.select("row_id", "old", F.col("v0").alias("new"), (F.col("v0") - F.col("old")).alias("delta"), reason.alias("reason"))


def cumulative_check(events: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """row_id, old, new, delta, reason of reported numbers of deals that were ever in some stages up to a day: match, or chained_count, since reports add up days."""
    wanted = groups.join(rows.select("row_id", F.col("ist_day").alias("_day")), "row_id").withColumnRenamed("stage", "_stage")
    met = events.join(F.broadcast(wanted), (events["stage"] == wanted["_stage"]) & (events["ist_day"] <= wanted["_day"]))
    found = rows.join(met.groupBy("row_id").agg(F.countDistinct("deal_id").alias("n")), "row_id", "left").withColumn("new", F.coalesce("n", F.lit(0)))
    return found.select("row_id", "old", "new", (F.col("new") - F.col("old")).alias("delta"), F.when(F.col("new") == F.col("old"), "match").otherwise("chained_count").alias("reason"))
