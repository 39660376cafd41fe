"""Performance report: counts of deals by metric and period, targets, and credit for stages that were skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Metrics in the order of the funnel. A metric's labels, and the label that a credited entry gets.
METRICS = ["assigned", "attempted", "picked", "interested", "setup", "completed", "shared", "received", "signed"]


def working_days(days: DataFrame, holidays: list[str]) -> DataFrame:
    """The days that are no weekend and no holiday."""
    off = F.weekday("ist_day") >= 5
    return days.filter(~off & ~F.col("ist_day").cast("string").isin(*holidays)) if holidays else days.filter(~off)


def label_counts(touches: DataFrame, today: str) -> DataFrame:
    """label, actor (null: the team): distinct deals ever, since the month's and since the week's start, in one pass."""
    d = F.lit(today).cast("date")
    periods = {"itd": F.lit(True), "mtd": F.col("ist_day") >= F.trunc(d, "month"), "wtd": F.col("ist_day") >= F.date_trunc("week", d).cast("date")}
    rows = touches.filter(F.col("ist_day") <= d).withColumn("who", F.explode(F.array(F.col("actor"), F.lit(None).cast("int"))))
    return rows.groupBy("stage_id", "who").agg(*[F.countDistinct(F.when(c, F.col("deal_id"))).alias(p) for p, c in periods.items()])


def cascade(touches: DataFrame, labels: DataFrame) -> DataFrame:
    """metric, deal_id, ist_day, synthetic: a deal's earliest touch of each metric, or, if it skipped one, of what follows it.

    labels: (stage_id, position) of the metrics' own labels; a label may be several metrics' own. A deal that touched a later
    metric but never the metric's own labels gets one entry at its earliest touch of the own or later labels. The earliest
    touch by position is found once; a running minimum from the last metric up gives the rest.
    """
    own = touches.join(F.broadcast(labels), "stage_id").groupBy("deal_id", "position").agg(F.min("entered_at").alias("own_at"))
    grid = own.groupBy("deal_id").agg(F.max("position").alias("last")).withColumn("position", F.explode(F.sequence(F.lit(0), F.col("last"))))
    rows = grid.join(own, ["deal_id", "position"], "left")
    later = Window.partitionBy("deal_id").orderBy(F.col("position").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("at", F.coalesce("own_at", F.min("own_at").over(later)))
    return rows.select("deal_id", "position", "at", F.col("own_at").isNull().alias("synthetic"))


def metric_days(touches: DataFrame, labels: DataFrame) -> DataFrame:
    """actor, position, ist_day, deals: each deal counts once a week for an actor and metric, on its first day there, so days add up to the week."""
    rows = touches.join(F.broadcast(labels), "stage_id").withColumn("week", F.date_trunc("week", "ist_day").cast("date"))
    first = rows.groupBy("actor", "position", "week", "deal_id").agg(F.min("ist_day").alias("ist_day"))
    return first.groupBy("actor", "position", "ist_day").agg(F.count("*").alias("deals"))


def row_formulas(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """position, total: a metric as the sum of its labels' counts; a deal may count on two labels."""
    team = counts.filter("who IS NULL")
    return team.join(F.broadcast(labels), "stage_id").groupBy("position").agg(F.sum("itd").alias("itd"), F.sum("mtd").alias("mtd"), F.sum("wtd").alias("wtd"))


def targets(weekly: DataFrame, elapsed: Column, days: int = 5) -> DataFrame:
    """The weekly target by working day, for the days that are over, rounded up."""
    return weekly.select("position", "target", F.ceil(F.col("target") * elapsed / F.lit(float(days))).alias("due"))


def achieved(done: Column, due: Column) -> Column:
    return F.when(due == 0, F.lit("N/A")).otherwise(F.format_string("%.1f%%", done * 100.0 / due))


def coverage_stats(touches: DataFrame, attempt: str, assigned: str, shared: str) -> DataFrame:
    """By pipeline: mean attempts a deal, share of assigned deals that were attempted, and of those attempted on the day they were assigned."""
    per = touches.groupBy("pipeline_id", "deal_id").agg(
        F.count_if(F.col("stage_id").startswith(attempt)).alias("attempts"), F.min(F.when(F.col("stage_id") == assigned, F.col("ist_day"))).alias("assigned_day"),
        F.min(F.when(F.col("stage_id").startswith(attempt), F.col("ist_day"))).alias("attempt_day"), F.min(F.when(F.col("stage_id") == shared, F.col("ist_day"))).alias("shared_day"),
    )
    given = F.col("assigned_day").isNotNull()
    return per.groupBy("pipeline_id").agg(
        F.sum("attempts").alias("attempts"), F.count_if(F.col("attempts") > 0).alias("attempted"), F.count_if(given).alias("assigned"), F.count_if(given & (F.col("attempts") > 0)).alias("touched"),
        F.count_if(F.col("assigned_day") == F.col("attempt_day")).alias("same_day"), F.count_if(F.col("shared_day").isNotNull()).alias("shared"),
    )


def resolve_labels(touches: DataFrame, sources: list[tuple[str, str]], relabel: DataFrame) -> DataFrame:
    """touches with label: the name of their stage in the first source (name, column) that has one, and the report's own name for it if there is one. relabel: label, to_label, a short list."""
    found = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for _, c in sources])
    rows = touches.withColumn("_found", found).join(F.broadcast(relabel.select(F.col("label").alias("_l"), "to_label")), F.col("_found") == F.col("_l"), "left")
    return rows.select(*touches.columns, F.coalesce("to_label", "_found").alias("label"))


def elapsed_days(days: DataFrame, start: str, today: str, holidays: list[str]) -> DataFrame:
    """elapsed: the working days from start to today."""
    inside = F.col("ist_day").between(F.lit(start).cast("date"), F.lit(today).cast("date"))
    return working_days(days, holidays).agg(F.count_if(inside).alias("elapsed"))


def rep_targets(weekly: DataFrame, reps: DataFrame, elapsed: DataFrame, days: int = 5) -> DataFrame:
    """rep, position, target, due: the team's weekly target split evenly over the reps, and by working day for the days that are over, rounded up. All are short lists."""
    n = reps.agg(F.count("*").alias("_n"))
    rows = weekly.join(F.broadcast(reps), how="cross").join(F.broadcast(n)).join(F.broadcast(elapsed))
    share = F.col("target") / F.col("_n")
    return rows.select("rep", "position", share.alias("target"), F.ceil(share * F.col("elapsed") / F.lit(float(days))).alias("due"))


def last_working_day(days: DataFrame, today: str, holidays: list[str]) -> DataFrame:
    """ist_day: the last working day before today."""
    return working_days(days, holidays).filter(F.col("ist_day") < F.lit(today).cast("date")).agg(F.max("ist_day").alias("ist_day"))


def report_table(touches: DataFrame, labels: DataFrame, today: str, day_columns: list[str]) -> DataFrame:
    """position, a column for each day, wtd, mtd, itd: distinct deals by metric, each deal once a metric and column, every metric there is."""
    d = F.lit(today).cast("date")
    own = touches.filter(F.col("ist_day") <= d).join(F.broadcast(labels), "stage_id").select("position", "deal_id", "ist_day").distinct()
    has = {f"d{x[-2:]}": F.col("ist_day") == F.lit(x).cast("date") for x in day_columns}
    has |= {"wtd": F.col("ist_day") >= F.date_trunc("week", d).cast("date"), "mtd": F.col("ist_day") >= F.trunc(d, "month"), "itd": F.lit(True)}
    by_deal = own.groupBy("position", "deal_id").agg(*[F.max(c).alias(n) for n, c in has.items()])
    counts = by_deal.groupBy("position").agg(*[F.count_if(n).alias(n) for n in has])
    return labels.select("position").distinct().join(counts, "position", "left").select("position", *[F.coalesce(n, F.lit(0)).alias(n) for n in has])


def granular(touches: DataFrame, tasks: DataFrame, today: str, stages: dict[str, str]) -> DataFrame:
    """rep (null: the team), period (day, wtd, mtd), attempted, attempts, bucket, with_task, assigned, same_day and their ratios.

    stages: the prefix or name of attempt, bucket and assigned stages. attempts counts events, attempted their deals; with_task
    the deals in the bucket with a completed task; same_day the deals attempted on the day they were assigned. A team's
    ratio is the ratio of the sums, not a mean of ratios; a ratio of nothing is null. tasks: deal_id, status.
    """
    d = F.lit(today).cast("date")
    periods = F.array_compact(F.array(F.when(F.col("ist_day") == d, F.lit("day")), F.when(F.col("ist_day") >= F.date_trunc("week", d).cast("date"), F.lit("wtd")), F.when(F.col("ist_day") >= F.trunc(d, "month"), F.lit("mtd"))))
    rows = touches.filter((F.col("ist_day") <= d) & F.col("actor").isNotNull()).withColumn("period", F.explode(periods))
    is_ = {n: F.col("stage_id").startswith(p) for n, p in stages.items()}
    per = rows.groupBy(F.col("actor").alias("rep"), "period", "deal_id").agg(
        F.count_if(is_["attempt"]).alias("attempts"), F.max(is_["bucket"]).alias("in_bucket"), F.min(F.when(is_["assigned"], F.col("ist_day"))).alias("given"), F.min(F.when(is_["attempt"], F.col("ist_day"))).alias("tried"))
    done = tasks.filter("status = 'COMPLETED'").select("deal_id", F.lit(True).alias("_task")).distinct()
    per = per.join(done, "deal_id", "left")
    sums = per.groupBy("rep", "period").agg(
        F.sum("attempts").alias("attempts"), F.count_if(F.col("attempts") > 0).alias("attempted"), F.count_if("in_bucket").alias("bucket"), F.count_if(F.col("in_bucket") & F.col("_task").isNotNull()).alias("with_task"),
        F.count("given").alias("assigned"), F.count_if(F.col("given") == F.col("tried")).alias("same_day"))
    names = ("attempts", "attempted", "bucket", "with_task", "assigned", "same_day")
    team = sums.groupBy("period").agg(*[F.sum(n).alias(n) for n in names]).withColumn("rep", F.lit(None).cast(sums.schema["rep"].dataType))
    both = sums.unionByName(team)
    ratio = lambda a, b: F.round(F.try_divide(F.col(a) * 1.0, F.col(b)), 4)
    return both.withColumns({"mean_attempts": ratio("attempts", "attempted"), "task_share": ratio("with_task", "bucket"), "same_day_share": ratio("same_day", "assigned")})
