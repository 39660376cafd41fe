"""Vendor credits: what calls cost, where credits went, and what a meter says that the ledger doesn't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.patterns import asof_join


def cost_of(calls: DataFrame, rates: DataFrame) -> DataFrame:
    """calls with the least and most credits by endpoint; a per-row rate counts the rows asked for. The rates are a short list."""
    rows = calls.join(F.broadcast(rates), "endpoint", "left")
    n = F.when(F.col("per_row"), F.col("rows")).otherwise(1)
    return rows.select(*calls.columns, F.coalesce(F.col("low") * n, F.lit(0)).alias("min_credits"), F.coalesce(F.col("high") * n, F.lit(0)).alias("max_credits"))


def charge_basis(measured: Column, rule: Column) -> Column:
    """A positive measured difference, else the rule's credits, else unknown."""
    basis = F.when(measured > 0, "measured").when(rule.isNotNull(), "rule").otherwise("unknown")
    return F.struct(basis.alias("basis"), F.when(measured > 0, measured).otherwise(rule).alias("credits"))


def report_by(calls: DataFrame, by: str, credits: str) -> DataFrame:
    """Credits and calls by a dimension, with a row for all (null)."""
    return calls.rollup(by).agg(F.count("*").alias("calls"), F.sum(credits).alias("credits"), F.grouping(by).cast("int").alias("is_total"))


def daily_audit(calls: DataFrame, day: str, outcome: str, credits: str) -> DataFrame:
    """Day by day: calls, those used and discarded, credits, and the running total."""
    daily = calls.groupBy(day).agg(F.count("*").alias("calls"), F.count_if(F.col(outcome) == "A").alias("used"), F.count_if(F.col(outcome) == "R").alias("discarded"), F.sum(credits).alias("credits"))
    w = Window.partitionBy(F.trunc(day, "year")).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("year_to_date", F.sum("credits").over(w))


def unlogged(readings: DataFrame, calls: DataFrame) -> DataFrame:
    """account, read_at, used, logged, unlogged: what the meter moved between two readings against what was logged in between.

    Calls are summed by time first. A reading's predecessor and the reading that ends a call's interval are found by as-of
    joins day by day of an account, so an account with all calls spreads over its days and no range is multiplied.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    day = lambda t: F.floor(t / F.lit(86_400_000_000))
    marks = readings.withColumn("_at", micros("read_at"))
    before = marks.select("account", "_at", F.col("meter").alias("_before"))
    moves = asof_join(marks.withColumn("_until", F.col("_at") - 1), before, "account", "_until", "_at", "_before", bucket=day)
    moves = moves.filter("_before IS NOT NULL").withColumn("used", F.col("meter") - F.col("_before"))
    summed = calls.groupBy("account", "called_at").agg(F.sum("credits").alias("credits")).withColumn("_back", -micros("called_at"))
    ends = marks.select("account", (-F.col("_at")).alias("_back_at"), F.col("read_at").alias("_mark"))
    logged = asof_join(summed, ends, "account", "_back", "_back_at", "_mark", bucket=day).filter("_mark IS NOT NULL")
    logged = logged.groupBy("account", F.col("_mark").alias("read_at")).agg(F.sum("credits").alias("logged"))
    rows = moves.join(logged, ["account", "read_at"], "left").withColumn("logged", F.coalesce("logged", F.lit(0)))
    return rows.select("account", "read_at", "used", "logged", (F.col("used") - F.col("logged")).alias("unlogged"))


def spread_intervals(spend: DataFrame, offsets: list[int]) -> DataFrame:
    """offset, day, credits: credits of intervals (start, end] spread evenly over their minutes, by the day at each offset from UTC, in minutes.

    The minutes of an interval on a day are a difference of clamped ends, so an interval costs a row a day and not a row a minute.
    """
    rows = spend.withColumn("offset", F.explode(F.array(*map(F.lit, offsets))))
    lo, hi = (F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / 60).cast("long") + F.col("offset") for c in ("start", "end"))
    rows = rows.withColumns({"lo": lo, "hi": hi}).withColumn("d", F.explode(F.sequence(F.floor(F.col("lo") / 1440), F.floor(F.col("hi") / 1440))))
    minutes = F.least(F.col("hi"), F.col("d") * 1440 + 1439) - F.greatest(F.col("lo"), F.col("d") * 1440) + 1
    rows = rows.withColumn("part", F.col("credits") * minutes / (F.col("hi") - F.col("lo") + 1))
    return rows.groupBy("offset", F.date_from_unix_date(F.col("d").cast("int")).alias("day")).agg(F.round(F.sum("part"), 6).alias("credits"))


def coverage(pages: DataFrame, people: DataFrame) -> DataFrame:
    """filter, reported, pages, people, pct, remaining: how much of what a search reports has been fetched."""
    a = pages.groupBy("filter").agg(F.max("reported").alias("reported"), F.count("*").alias("pages"))
    b = people.groupBy("filter").agg(F.countDistinct("person").alias("people"))
    rows = a.join(b, "filter", "left").withColumn("people", F.coalesce("people", F.lit(0)))
    return rows.select("*", F.round(100.0 * F.col("people") / F.col("reported"), 1).alias("pct"), F.greatest(F.lit(0), F.col("reported") - F.col("people")).alias("remaining"))
