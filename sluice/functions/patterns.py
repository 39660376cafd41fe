"""Patterns that several operators share: calendars, as-of joins, rolling distinct counts, demand matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.ranks import bucketed_sums, placed

#: Minutes from UTC to the reporting day.
IST_MINUTES = 330


def ist_day(ts: Column) -> Column:
    return (ts + F.expr(f"INTERVAL {IST_MINUTES} MINUTES")).cast("date")


def calendar(df: DataFrame, day: str = "ist_day") -> DataFrame:
    """A row for each day from the least to the largest."""
    return df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias(day))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, *, backward_fill: bool = False, bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    """left with `value` of right's last row of the same key at or before left_time.

    Both sides are put in one order by key and time, right's rows first among equal times, so one shuffle by key serves both
    and nothing is multiplied. With backward_fill, rows before the first value get the first one. Where a few keys hold all
    rows, `bucket` names the stretch of time that a time is in, growing with it: only a stretch of a key is sorted together,
    and the last value of the stretches before it is carried over, a row for each.
    """
    none = F.lit(None).cast(right.schema[value].dataType)
    l = left.select(F.struct(*left.columns).alias("_row"), F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), none.alias("_v"))
    r = right.select(F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = l.unionByName(r).withColumn("_b", bucket(F.col("_t")) if bucket else F.lit(0))
    keys = ["_k", "_b"] if bucket else ["_k"]
    w = Window.partitionBy(*keys).orderBy("_t", "_side", F.col("_v").asc_nulls_first())
    found = F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if backward_fill:
        found = F.coalesce(found, F.first("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = both.withColumn("_found", found)
    if bucket:
        at = F.when(F.col("_v").isNotNull(), F.struct("_t", "_v"))
        ends = both.groupBy("_k", "_b").agg(F.max(at).alias("_last"), F.min(at).alias("_first"))
        stretches = Window.partitionBy("_k").orderBy("_b")
        before = F.last("_last", ignorenulls=True).over(stretches.rowsBetween(Window.unboundedPreceding, -1))["_v"]
        after = F.first("_first", ignorenulls=True).over(stretches.rowsBetween(1, Window.unboundedFollowing))["_v"]
        carried = ends.select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"), before.alias("_before"), after.alias("_after"))
        rows = rows.join(carried, rows["_k"].eqNullSafe(carried["_ck"]) & rows["_b"].eqNullSafe(carried["_cb"]))
        own = F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # a value of the stretch comes first, then what was carried into it; only then what follows
        rows = rows.withColumn("_own", own).withColumn("_found", F.coalesce("_own", "_before", *(["_found", "_after"] if backward_fill else [])))
    return rows.filter("_side = 1").select("_row.*", F.col("_found").alias(value))


def rolling_distinct(df: DataFrame, keys: list[str], entity: str, day: str, days: int) -> DataFrame:
    """keys, day, n: distinct entities seen in the `days` days that end on it, of the days that have any.

    An entity's days become stretches on which it counts, each until `days` after the last of its days that lie less than that
    apart; +1 where one begins and -1 where it ends are summed over the days. So an entity is shuffled once with its set of
    days, and two narrow steps a stretch follow, however long the window is. Nulls of entity and day count nowhere.
    """
    seen = df.filter(F.col(entity).isNotNull() & F.col(day).isNotNull())
    own = seen.groupBy(*keys, entity).agg(F.sort_array(F.collect_set(day)).alias("_days"))
    at = lambda i: F.get(F.col("_days"), i)
    begins = F.filter("_days", lambda d, i: F.coalesce(F.date_diff(d, at(i - 1)) >= days, F.lit(True)))
    ends = F.filter("_days", lambda d, i: F.coalesce(F.date_diff(at(i + 1), d) >= days, F.lit(True)))
    step = lambda d, n: F.struct(d.alias(day), F.lit(n).alias("_n"))
    steps = F.concat(F.transform(begins, lambda d: step(d, 1)), F.transform(ends, lambda d: step(F.date_add(d, days), -1)))
    changes = own.select(*keys, F.explode(steps).alias("_s")).groupBy(*keys, F.col(f"_s.{day}").alias("_from")).agg(F.sum("_s._n").alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_from")  # a row for each day of a key
    running = changes.select(*keys, "_from", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"), F.lead("_from").over(w).alias("_to")).filter("n > 0")
    return running.select(*keys, F.explode(F.sequence("_from", F.date_sub("_to", 1))).alias(day), "n")


def take_by_demand(pool: DataFrame, demand: DataFrame, key: list[str], pool_order: list[Column], demand_order: list[Column], need: str, *, stretch: int = 10_000) -> DataFrame:
    """Rows of pool, each given to at most one row of demand with the same key, which takes `need` of them in order.

    The n-th row of the pool goes to the demand whose running total of needs covers n. Places and totals come from ranges of a
    key (placed), and pool and demand meet in one order within a stretch of `stretch` places of a key: a demand is put where
    it begins in each stretch that it covers, and a row of the pool takes the last one before it. So neither a hot key nor a
    key with many demands is multiplied or comes to one task. Rows with a null in the key meet nothing.
    """
    p = placed(pool.dropna(subset=key), key, pool_order, "_n")
    d = placed(demand.dropna(subset=key), key, demand_order, "_place").filter(F.col(need) > 0)
    d = d.withColumn("_chunk", F.floor(F.col("_place") / stretch))
    d = bucketed_sums(d, key, ["_chunk"], ["_place"], F.col(need), "_lo").withColumn("_hi", F.col("_lo") + F.col(need))
    starts = d.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_lo") / stretch), F.floor((F.col("_hi") - 1) / stretch))))
    own = [c for c in demand.columns if c not in key]
    starts = starts.select(*key, "_b", F.greatest("_lo", F.col("_b") * stretch).alias("_at"), F.struct(*own, "_hi").alias("_d"))
    rows = p.select(*key, F.floor(F.col("_n") / stretch).alias("_b"), F.col("_n").alias("_at"), F.struct(*[c for c in pool.columns if c not in key]).alias("_p"))
    both = rows.unionByName(starts, allowMissingColumns=True)
    w = Window.partitionBy(*key, "_b").orderBy("_at", F.col("_d").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("_d", F.last("_d", ignorenulls=True).over(w)).filter(F.col("_p").isNotNull() & (F.col("_at") < F.col("_d._hi")))
    return met.select(*key, "_p.*", *[F.col(f"_d.{c}").alias(c) for c in own])


def change(prev: Column, cur: Column, complete: Column, least: int = 10) -> Column:
    """Absolute change and how to show it: new from 0, flat at 0, partial if a window isn't complete, pct if prev is at least `least`, else abs."""
    flag = F.when((prev == 0) & (cur > 0), "new").when((prev == 0) & (cur == 0), "flat").when(~complete, "partial").when(prev >= least, "pct").otherwise("abs")
    pct = F.when(flag == "pct", F.round((cur - prev) * 100.0 / prev, 1))
    return F.struct((cur - prev).alias("delta"), flag.alias("flag"), pct.alias("pct"))
