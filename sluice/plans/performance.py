"""Performance-report queries over the given events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import performance as pf
from sluice.plans import funnel, model

QUERIES: dict = {}
SQL: dict[str, str] = {}
DAY = funnel.DAY
#: (label, metric's position) of the given stages; view_3 belongs to two metrics.
LABELS = [
    ("click_0", 0), ("click_1", 1), ("click_2", 1), ("click_3", 2), ("view_0", 2), ("view_1", 3), ("view_2", 4), ("view_3", 5), ("view_3", 6), ("signup_0", 7), ("purchase_1", 8),
]
TARGETS = [(p, float(40 - 4 * p)) for p in range(9)]
L = f"la AS ({model.values_sql(LABELS, 'stage_id, position')}), ta AS ({model.values_sql(TARGETS, 'position, target')})"


def query(name: str, body: str):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(funnel.World(spark, sf_dir), spark.sql(model.values_sql(LABELS, "stage_id, position")))
        SQL[name] = model.funnel_sql(f", {L} {body}")
        return f

    return add


COUNTS = f"cn AS (SELECT stage_id, who, count(DISTINCT deal_id) AS itd, count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-01') AS mtd, count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-15') AS wtd FROM (SELECT stage_id, actor AS who, deal_id, ist_day FROM e UNION ALL SELECT stage_id, NULL, deal_id, ist_day FROM e) WHERE ist_day <= DATE '{DAY}' GROUP BY stage_id, who)"


@query("label_counts", f", {COUNTS} SELECT * FROM cn")
def _(w, labels):
    return pf.label_counts(w.events, DAY)


@query("row_formulas", f", {COUNTS} SELECT position, CAST(sum(itd) AS BIGINT) AS itd, CAST(sum(mtd) AS BIGINT) AS mtd, CAST(sum(wtd) AS BIGINT) AS wtd FROM (SELECT stage_id, count(DISTINCT deal_id) AS itd, count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-01') AS mtd, count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-15') AS wtd FROM e WHERE ist_day <= DATE '{DAY}' GROUP BY stage_id) c JOIN la ON la.stage_id = c.stage_id GROUP BY position")
def _(w, labels):
    team = w.events.withColumn("actor", F.lit(None).cast("int"))
    return pf.row_formulas(pf.label_counts(team, DAY), labels)


@query("cascade_augment", ", o AS (SELECT deal_id, position, min(entered_at) AS own_at FROM e JOIN la ON e.stage_id = la.stage_id GROUP BY ALL), g AS (SELECT deal_id, CAST(unnest(range(0, m + 1)) AS INT) AS position FROM (SELECT deal_id, max(position) AS m FROM o GROUP BY deal_id)) SELECT g.deal_id, g.position, coalesce(o.own_at, (SELECT min(p.own_at) FROM o p WHERE p.deal_id = g.deal_id AND p.position >= g.position)) AS at, o.own_at IS NULL AS synthetic FROM g LEFT JOIN o ON o.deal_id = g.deal_id AND o.position = g.position")
def _(w, labels):
    return pf.cascade(w.events, labels)


@query("rep_day_counts", "SELECT actor, position, ist_day, count(*) AS deals FROM (SELECT actor, position, date_trunc('week', ist_day) AS week, deal_id, min(ist_day) AS ist_day FROM e JOIN la ON e.stage_id = la.stage_id GROUP BY ALL) GROUP BY actor, position, ist_day")
def _(w, labels):
    return pf.metric_days(w.events, labels)


@query("targets_achieved", f", c AS (SELECT position, count(DISTINCT deal_id) AS done FROM e JOIN la ON e.stage_id = la.stage_id WHERE ist_day BETWEEN DATE '2024-01-15' AND DATE '{DAY}' GROUP BY position) SELECT ta.position, target, CAST(ceil(target * 3 / 5) AS BIGINT) AS due, coalesce(done, 0) AS done, CASE WHEN target = 0 THEN 'N/A' ELSE printf('%.1f%%', coalesce(done, 0) * 100.0::DOUBLE / ceil(target * 3 / 5)) END AS pct FROM ta LEFT JOIN c ON ta.position = c.position")
def _(w, labels):
    weekly = w.spark.sql(model.values_sql(TARGETS, "position, target"))
    seen = w.events.filter(F.col("ist_day").between("2024-01-15", DAY)).join(F.broadcast(labels), "stage_id").groupBy("position").agg(F.countDistinct("deal_id").alias("done"))
    rows = pf.targets(weekly, F.lit(3.0)).join(seen, "position", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    return rows.withColumn("pct", pf.achieved(F.col("done"), F.col("due")))


@query("union_dedup_bucket", "SELECT pipeline_id, count(DISTINCT deal_id) FILTER (stage_id IN ('click_0', 'click_1')) AS early, count(DISTINCT deal_id) FILTER (stage_id IN ('purchase_0', 'purchase_1', 'signup_2')) AS late FROM e GROUP BY pipeline_id")
def _(w, labels):
    pick = lambda *s: F.countDistinct(F.when(F.col("stage_id").isin(*s), F.col("deal_id")))
    return w.events.groupBy("pipeline_id").agg(pick("click_0", "click_1").alias("early"), pick("purchase_0", "purchase_1", "signup_2").alias("late"))


@query("granular_stats", "SELECT pipeline_id, CAST(sum(n) AS BIGINT) AS attempts, count(*) FILTER (n > 0) AS attempted, count(a) AS assigned, count(a) FILTER (n > 0) AS touched, count(*) FILTER (a = t) AS same_day, count(s) AS shared FROM (SELECT pipeline_id, deal_id, count(*) FILTER (starts_with(stage_id, 'view')) AS n, min(ist_day) FILTER (stage_id = 'click_0') AS a, min(ist_day) FILTER (starts_with(stage_id, 'view')) AS t, min(ist_day) FILTER (stage_id = 'signup_0') AS s FROM e GROUP BY pipeline_id, deal_id) GROUP BY pipeline_id")
def _(w, labels):
    return pf.coverage_stats(w.events, "view", "click_0", "signup_0")


@query("last_working_day", "SELECT position, count(DISTINCT deal_id) AS deals FROM e JOIN la ON e.stage_id = la.stage_id WHERE ist_day = (SELECT max(ist_day) FROM e WHERE ist_day < DATE '2024-01-22' AND isodow(ist_day) < 6 AND ist_day <> DATE '2024-01-19') GROUP BY position")
def _(w, labels):
    day = pf.last_working_day(w.days, "2024-01-22", ["2024-01-19"])
    return w.events.join(F.broadcast(day), "ist_day").join(F.broadcast(labels), "stage_id").groupBy("position").agg(F.countDistinct("deal_id").alias("deals"))


WEEK = [f"2024-01-{d}" for d in range(15, 21)]


@query("full_report_rows", "SELECT p.position, " + ", ".join(f"count(DISTINCT deal_id) FILTER (ist_day = DATE '{d}') AS d{d[-2:]}" for d in WEEK) + f", count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-15') AS wtd, count(DISTINCT deal_id) FILTER (ist_day >= DATE '2024-01-01') AS mtd, count(DISTINCT deal_id) AS itd FROM (SELECT DISTINCT position FROM la) p LEFT JOIN (SELECT position, deal_id, ist_day FROM e JOIN la ON e.stage_id = la.stage_id WHERE ist_day <= DATE '{DAY}') q ON q.position = p.position GROUP BY p.position")
def _(w, labels):
    return pf.report_table(w.events, labels, DAY, WEEK)


RELABEL = [("click_1", "Attempted"), ("view_2", "Setup")]


@query("resolved_labels", f", rl AS ({model.values_sql(RELABEL, 'label, to_label')}) SELECT label, count(*) AS events, count(DISTINCT deal_id) AS deals FROM (SELECT deal_id, coalesce(rl.to_label, n) AS label FROM (SELECT e.*, CASE WHEN pipeline_id = 0 THEN stage_id WHEN pipeline_id < 3 THEN upper(stage_id) END AS n FROM e) k LEFT JOIN rl ON rl.label = n) GROUP BY label")
def _(w, labels):
    rows = w.events.withColumns({"own": F.when(F.col("pipeline_id") == 0, F.col("stage_id")).otherwise(F.lit(" ")), "other": F.when(F.col("pipeline_id") < 3, F.upper("stage_id"))})
    named = pf.resolve_labels(rows, [("first", "own"), ("second", "other")], w.spark.sql(model.values_sql(RELABEL, "label, to_label")))
    return named.groupBy("label").agg(F.count("*").alias("events"), F.countDistinct("deal_id").alias("deals"))


@query("rep_targets", ", el AS (SELECT count(*) AS k FROM (SELECT DISTINCT ist_day FROM e WHERE ist_day BETWEEN DATE '2024-01-15' AND DATE '2024-01-18' AND isodow(ist_day) < 6 AND ist_day <> DATE '2024-01-16')), rp AS (SELECT DISTINCT actor AS rep FROM e WHERE actor IS NOT NULL), n AS (SELECT count(*) AS n FROM rp) SELECT CAST(rep AS BIGINT) AS rep, position, target / n AS target, CAST(ceil(target / n * k / 5) AS BIGINT) AS due FROM ta, rp, n, el")
def _(w, labels):
    weekly = w.spark.sql(model.values_sql(TARGETS, "position, target"))
    reps = w.events.filter("actor IS NOT NULL").select(F.col("actor").cast("long").alias("rep")).distinct()
    return pf.rep_targets(weekly, reps, pf.elapsed_days(w.days, "2024-01-15", "2024-01-18", ["2024-01-16"]))


@query("rep_granular", f", q AS (SELECT actor AS rep, period, deal_id, count(*) FILTER (starts_with(stage_id, 'view')) AS n, bool_or(starts_with(stage_id, 'signup')) AS b, min(ist_day) FILTER (starts_with(stage_id, 'click_0')) AS g, min(ist_day) FILTER (starts_with(stage_id, 'view')) AS t FROM e, (VALUES ('day', DATE '{DAY}'), ('wtd', DATE '2024-01-15'), ('mtd', DATE '2024-01-01')) AS p(period, since) WHERE ist_day <= DATE '{DAY}' AND ist_day >= since AND actor IS NOT NULL GROUP BY ALL), z AS (SELECT rep, period, n, b, g, t, deal_id % 3 = 0 AS done FROM q UNION ALL SELECT NULL, period, n, b, g, t, deal_id % 3 = 0 FROM q), s AS (SELECT rep, period, CAST(sum(n) AS BIGINT) AS attempts, count(*) FILTER (n > 0) AS attempted, count(*) FILTER (b) AS bucket, count(*) FILTER (b AND done) AS with_task, count(g) AS assigned, count(*) FILTER (g = t) AS same_day FROM z GROUP BY rep, period) SELECT *, round(attempts / nullif(attempted, 0)::DOUBLE, 4) AS mean_attempts, round(with_task / nullif(bucket, 0)::DOUBLE, 4) AS task_share, round(same_day / nullif(assigned, 0)::DOUBLE, 4) AS same_day_share FROM s")
def _(w, labels):
    tasks = w.deals.select("deal_id", F.when(F.col("deal_id") % 3 == 0, "COMPLETED").otherwise("OPEN").alias("status"))
    return pf.granular(w.events, tasks, DAY, {"attempt": "view", "bucket": "signup", "assigned": "click_0"})
