"""Funnel queries over the given events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.patterns import asof_join, calendar, change, rolling_distinct
from sluice.functions.staging import scratch_path
from sluice.operators import events as ev
from sluice.operators import metrics as mt
from sluice.operators import occupancy as oc
from sluice.plans import model
from sluice.plans.model import funnel_sql
from sluice.sources.files import write_days

DAY = "2024-01-20"
QUERIES: dict = {}
SQL: dict[str, str] = {}


class World:
    """The funnel's frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.events = spark, model.stage_events(spark, sf_dir)
        self.stages = ev.effective_stages(model.stage_map(spark), model.rungs(spark), model.reasons(spark))
        self.x = ev.enrich(self.events, self.stages)
        self.deals = model.deals(self.events)
        self.days = calendar(self.events)


def query(name: str, body: str):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(World(spark, sf_dir))
        SQL[name] = funnel_sql(body)
        return f

    return add


PAIRS = """count(DISTINCT CASE WHEN is_human THEN deal_id || ':' || coalesce(CAST(actor AS VARCHAR), '-') END) AS entries_human,
count(DISTINCT CASE WHEN NOT is_human THEN deal_id || ':' || coalesce(CAST(actor AS VARCHAR), '-') END) AS entries_auto,
count(DISTINCT CASE WHEN is_human THEN deal_id || ':' || coalesce(CAST(actor AS VARCHAR), '-') END) + count(DISTINCT CASE WHEN NOT is_human THEN deal_id || ':' || coalesce(CAST(actor AS VARCHAR), '-') END) AS entries_total,
count(DISTINCT CASE WHEN is_human THEN deal_id END) AS deals_human, count(DISTINCT deal_id) AS deals_all"""
ANY = "deal_id || ':' || coalesce(CAST(actor AS VARCHAR), '-') || is_human"
COHORT = f"""j AS (SELECT deal_id, min(ist_day) AS joined_day FROM e GROUP BY deal_id), co AS (SELECT j.deal_id, joined_day,
joined_day >= DATE '2024-01-03' AND NOT (joined_day = DATE '2024-01-05' AND coalesce(created_day < joined_day, true)) AS in_scope FROM j JOIN d ON j.deal_id = d.deal_id)"""
CELLS = f"""cells AS (SELECT funnel, level, key, ist_day, {PAIRS} FROM (
SELECT deal_id, actor, is_human, ist_day, f.funnel, l.level, CASE l.level WHEN 'c' THEN rung WHEN 's' THEN stage_id ELSE reason END AS key
FROM x, (VALUES (0), (1)) AS w(w), (VALUES ('c'), ('s'), ('r')) AS l(level), LATERAL (SELECT CASE WHEN w = 0 THEN CAST(pipeline_id AS VARCHAR) ELSE 'ALL' END AS funnel) AS f
) WHERE key IS NOT NULL GROUP BY ALL)"""
CAL = "cal AS (SELECT CAST(unnest(generate_series(min(ist_day), max(ist_day), INTERVAL 1 DAY)) AS DATE) AS ist_day FROM e)"
IN7, IN1, INP = (f"ist_day BETWEEN DATE '{DAY}' - {a} AND DATE '{DAY}' - {b}" for a, b in ((6, 0), (0, 0), (13, 7)))


@query("stage_effective", "SELECT sm.stage_id, sm.rung, sm.reason, sm.depth_reached, rg.depth, coalesce(sm.own_attempt, rs.attempt, rg.attempt, false) AS attempt, coalesce(rs.connected, rg.connected, false) AS connected, coalesce(rg.interested, false) AS interested, e.n AS events FROM sm LEFT JOIN rg ON sm.rung = rg.code LEFT JOIN rs ON sm.reason = rs.code JOIN (SELECT stage_id, count(*) AS n FROM e GROUP BY stage_id) e ON e.stage_id = sm.stage_id")
def _(w):
    return w.stages.join(w.events.groupBy("stage_id").agg(F.count("*").alias("events")), "stage_id")


@query("stage_event_enriched", "SELECT event_id, deal_id, stage_id, rung, reason, attempt, connected, interested, ist_day FROM x")
def _(w):
    return w.x.select("event_id", "deal_id", "stage_id", "rung", "reason", "attempt", "connected", "interested", "ist_day")


@query("deal_current", "SELECT d.deal_id, d.account_id, d.pipeline_id, d.created_day, d.stage_id, d.is_archived, sm.rung, sm.reason, d.owner, o.name AS owner_name, d.company, d.lead_source FROM d LEFT JOIN sm ON d.stage_id = sm.stage_id LEFT JOIN (SELECT k AS owner, 'Owner ' || k AS name FROM range(9) AS t(k)) o ON o.owner = d.owner")
def _(w):
    owners = w.spark.range(9).select(F.col("id").alias("owner"), F.concat(F.lit("Owner "), F.col("id").cast("string")).alias("owner_name"))
    rows = w.deals.join(F.broadcast(w.stages.select("stage_id", "rung", "reason")), "stage_id", "left").join(F.broadcast(owners), "owner", "left")
    return rows.select("deal_id", "account_id", "pipeline_id", "created_day", "stage_id", "is_archived", "rung", "reason", "owner", "owner_name", "company", "lead_source")


@query("funnel_entries_daily", f"SELECT account_id, pipeline_id, stage_id, ist_day, {PAIRS} FROM e GROUP BY account_id, pipeline_id, stage_id, ist_day")
def _(w):
    return ev.entries(w.events, ["account_id", "pipeline_id", "stage_id", "ist_day"])


@query("funnel_entries_in_scope", f", {COHORT} SELECT stage_id, ist_day, {PAIRS} FROM e WHERE deal_id IN (SELECT deal_id FROM co WHERE in_scope) GROUP BY stage_id, ist_day")
def _(w):
    scope = ev.cohort(w.events, w.deals, "2024-01-03", "2024-01-05").filter("in_scope")
    return ev.entries(w.events.join(scope, "deal_id", "left_semi"), ["stage_id", "ist_day"])


@query("funnel_entries_canonical", f"SELECT rung, ist_day, {PAIRS} FROM x GROUP BY rung, ist_day")
def _(w):
    return ev.entries(w.x, ["rung", "ist_day"])


@query("funnel_canonical_rollup", f"SELECT rung, CAST(sum(entries_total) AS BIGINT) AS entries_total, count(*) AS days FROM (SELECT rung, ist_day, {PAIRS} FROM x GROUP BY rung, ist_day) GROUP BY rung")
def _(w):
    return ev.entries(w.x, ["rung", "ist_day"]).groupBy("rung").agg(F.sum("entries_total").alias("entries_total"), F.count("*").alias("days"))


@query("deal_cohort", f", {COHORT} SELECT deal_id, joined_day, in_scope FROM co")
def _(w):
    return ev.cohort(w.events, w.deals, "2024-01-03", "2024-01-05")


@query("funnel_cells", f", {CELLS} SELECT * FROM cells")
def _(w):
    return ev.cells(w.x)


@query("funnel_stage_counts", "SELECT sm.stage_id, count(d.deal_id) AS deals FROM sm LEFT JOIN d ON sm.stage_id = d.stage_id AND NOT d.is_archived GROUP BY sm.stage_id")
def _(w):
    return ev.stage_occupancy(w.stages, w.deals)


@query("deal_canonical_reach", "SELECT deal_id, rung, min(ist_day) AS first_day, max(ist_day) AS last_day, count(*) AS events FROM x GROUP BY deal_id, rung")
def _(w):
    return ev.reach(w.x)


@query("event_pipeline_guess", "SELECT stage_id, count(*) AS events, count(DISTINCT pipeline_id) AS pipelines FROM e GROUP BY stage_id")
def _(w):
    return w.events.groupBy("stage_id").agg(F.count("*").alias("events"), F.countDistinct("pipeline_id").alias("pipelines"))


TWICE = "SELECT *, 'history' AS origin FROM e UNION ALL SELECT event_id, date_trunc('second', entered_at)::TIMESTAMP AS entered_at, * EXCLUDE (event_id, entered_at), 'csv' AS origin FROM e WHERE event_id % 4 < 2"


@query("near_duplicate_events", f" SELECT deal_id, pipeline_id, stage_id, same, n, origins, first_event FROM (SELECT deal_id, pipeline_id, stage_id, date_trunc('second', entered_at)::TIMESTAMP AS same, count(*) AS n, array_to_string(list_sort(list(DISTINCT origin)), ',') AS origins, min(event_id) AS first_event FROM ({TWICE}) GROUP BY ALL) WHERE n > 1")
def _(w):
    known = w.events.withColumn("origin", F.lit("history"))
    listed = w.events.filter("event_id % 4 < 2").withColumns({"entered_at": F.date_trunc("second", "entered_at").cast("timestamp_ntz"), "origin": F.lit("csv")})
    return ev.near_duplicates(known.unionByName(listed)).withColumn("same", F.col("same").cast("timestamp_ntz"))


@query("stage_dwell", "SELECT event_id, deal_id, stage_id, floor((date_diff('microsecond', entered_at, lead(entered_at) OVER (PARTITION BY deal_id ORDER BY entered_at, event_id)) // 1000000 * 10 + 18) / 36::DOUBLE) / 1000::DOUBLE AS hours FROM e")
def _(w):
    return ev.stage_dwell(w.events)


@query("deal_state_drift", "SELECT d.deal_id, d.stage_id AS deal_stage, n.stage_id AS event_stage FROM d JOIN (SELECT deal_id, stage_id, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at DESC, event_id DESC) AS r FROM e) n ON d.deal_id = n.deal_id AND r = 1 WHERE d.stage_id IS DISTINCT FROM n.stage_id")
def _(w):
    return ev.state_drift(w.events, w.deals)


@query("deal_first_human_event", "SELECT deal_id, event_id, ist_day, stage_id, pipeline_id, actor FROM (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at, event_id) AS r FROM e WHERE is_human) WHERE r = 1")
def _(w):
    return ev.first_events(w.events.filter("is_human"))


@query("build_transitions", "SELECT event_id, deal_id, before_stage AS from_stage, stage_id AS to_stage FROM (SELECT *, lag(stage_id) OVER w AS before_stage, lag(pipeline_id) OVER w AS before_pipeline FROM e WINDOW w AS (PARTITION BY deal_id ORDER BY entered_at, event_id)) WHERE before_stage IS DISTINCT FROM stage_id OR before_pipeline IS DISTINCT FROM pipeline_id")
def _(w):
    return ev.transitions(w.events)


@query("inception_curve", "SELECT rung, ist_day, n AS new, CAST(sum(n) OVER (PARTITION BY rung ORDER BY ist_day) AS BIGINT) AS total FROM (SELECT rung, ist_day, count(*) AS n FROM (SELECT rung, deal_id, min(ist_day) AS ist_day FROM x GROUP BY rung, deal_id) GROUP BY rung, ist_day)")
def _(w):
    return mt.inception_curve(w.x)


@query("rolling_entries", f", {CAL}, dd AS (SELECT rung, ist_day, {PAIRS} FROM x GROUP BY rung, ist_day), g AS (SELECT r.rung, cal.ist_day, coalesce(entries_total, 0) AS today FROM (SELECT DISTINCT rung FROM x) r CROSS JOIN cal LEFT JOIN dd ON dd.rung = r.rung AND dd.ist_day = cal.ist_day) SELECT rung, ist_day, today, CAST(sum(today) OVER (PARTITION BY rung ORDER BY ist_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS roll7, CAST(coalesce(sum(today) OVER (PARTITION BY rung ORDER BY ist_day ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 0) AS BIGINT) AS prev7 FROM g")
def _(w):
    return mt.rolling_sums(ev.entries(w.x, ["rung", "ist_day"]), w.days, "rung", "entries_total")


@query("rolling_engaged_distinct", "SELECT pipeline_id, ist_day, count(DISTINCT deal_id) AS n FROM (SELECT pipeline_id, deal_id, CAST(unnest(generate_series(ist_day, ist_day + 6, INTERVAL 1 DAY)) AS DATE) AS ist_day FROM (SELECT DISTINCT pipeline_id, deal_id, ist_day FROM e WHERE is_human)) GROUP BY pipeline_id, ist_day")
def _(w):
    return rolling_distinct(w.events.filter("is_human"), ["pipeline_id"], "deal_id", "ist_day", 7)


@query("occupancy_series", f", {CAL} SELECT r.rung, cal.ist_day, count(s.deal_id) AS deals FROM (SELECT DISTINCT rung FROM x) r CROSS JOIN cal LEFT JOIN (SELECT l.deal_id, rung, ist_day, lead(ist_day) OVER (PARTITION BY l.deal_id ORDER BY ist_day) AS until, d.archived_day FROM (SELECT deal_id, ist_day, rung, row_number() OVER (PARTITION BY deal_id, ist_day ORDER BY entered_at DESC, event_id DESC) AS n FROM x) l JOIN d ON d.deal_id = l.deal_id AND (NOT d.is_archived OR d.archived_day IS NOT NULL) WHERE n = 1) s ON s.rung = r.rung AND s.ist_day <= cal.ist_day AND (s.until IS NULL OR s.until > cal.ist_day) AND (s.archived_day IS NULL OR s.archived_day > cal.ist_day) GROUP BY r.rung, cal.ist_day")
def _(w):
    return ev.occupancy_series(w.x, w.days, w.deals)


@query("owner_asof", "SELECT e.event_id, e.deal_id, o.actor AS owner FROM e ASOF LEFT JOIN (SELECT deal_id, entered_at, max(actor) AS actor FROM e WHERE actor IS NOT NULL AND event_id % 5 = 0 GROUP BY deal_id, entered_at) o ON e.deal_id = o.deal_id AND e.entered_at >= o.entered_at")
def _(w):
    owners = w.events.filter("actor IS NOT NULL AND event_id % 5 = 0").select("deal_id", F.col("entered_at").alias("assigned_at"), F.col("actor").alias("owner"))
    return asof_join(w.events.select("event_id", "deal_id", "entered_at"), owners, "deal_id", "entered_at", "assigned_at", "owner").select("event_id", "deal_id", "owner")


@query("pipeline_asof_backfill", "SELECT e.event_id, coalesce(o.p, f.p) AS pipeline FROM e ASOF LEFT JOIN (SELECT deal_id, entered_at, max(pipeline_id) AS p FROM e WHERE event_id % 4 = 0 GROUP BY ALL) o ON e.deal_id = o.deal_id AND e.entered_at >= o.entered_at LEFT JOIN (SELECT deal_id, arg_min(pipeline_id, entered_at) AS p FROM e WHERE event_id % 4 = 0 GROUP BY deal_id) f ON e.deal_id = f.deal_id")
def _(w):
    known = w.events.filter("event_id % 4 = 0").select("deal_id", F.col("entered_at").alias("at"), F.col("pipeline_id").alias("pipeline"))
    return asof_join(w.events.select("event_id", "deal_id", "entered_at"), known, "deal_id", "entered_at", "at", "pipeline", backward_fill=True).select("event_id", "pipeline")


@query("rung_entries", f", {CELLS}, s AS (SELECT key AS rung, CAST(coalesce(sum(entries_total) FILTER ({IN1}), 0) AS BIGINT) AS today, CAST(coalesce(sum(entries_total) FILTER (ist_day = DATE '{DAY}' - 1), 0) AS BIGINT) AS yesterday, CAST(coalesce(sum(entries_total) FILTER ({IN7}), 0) AS BIGINT) AS roll7, CAST(coalesce(sum(entries_total) FILTER ({INP}), 0) AS BIGINT) AS prev7 FROM cells WHERE funnel = 'ALL' AND level = 'c' AND ist_day <= DATE '{DAY}' GROUP BY key), u AS (SELECT rung, count(DISTINCT deal_id) FILTER ({IN7}) AS deals7, count(DISTINCT deal_id) AS inception, count(DISTINCT deal_id) FILTER (is_human) AS inception_human FROM x WHERE ist_day <= DATE '{DAY}' GROUP BY rung) SELECT s.*, deals7, inception, inception_human FROM s JOIN u ON s.rung = u.rung")
def _(w):
    return mt.rung_entries(ev.cells(w.x), w.x, DAY)


@query("engaged", ", h AS (SELECT DISTINCT deal_id, ist_day FROM e WHERE is_human), a AS (SELECT ist_day, count(*) AS engaged FROM h GROUP BY ist_day), f AS (SELECT deal_id, min(ist_day) AS ist_day FROM h GROUP BY deal_id), b AS (SELECT deal_id, min(ist_day) AS bad_day FROM x WHERE reason = 'BAD_CONTACT' GROUP BY deal_id), n AS (SELECT f.ist_day, count(*) AS n FROM f LEFT JOIN b ON f.deal_id = b.deal_id WHERE bad_day IS NULL OR bad_day > f.ist_day GROUP BY f.ist_day) SELECT a.ist_day, engaged, (SELECT count(DISTINCT deal_id) FROM h WHERE h.ist_day BETWEEN a.ist_day - 6 AND a.ist_day) AS engaged7, (SELECT count(DISTINCT deal_id) FROM h WHERE h.ist_day BETWEEN a.ist_day - 13 AND a.ist_day - 7) AS engaged_prev7, coalesce(n.n, 0) AS net_new FROM a LEFT JOIN n ON a.ist_day = n.ist_day")
def _(w):
    return mt.engaged(w.events, w.x)


@query("leads_assigned", f", s AS (SELECT ist_day, count(DISTINCT {ANY}) AS sourced FROM x WHERE rung = 'SOURCED' GROUP BY ist_day), n AS (SELECT ist_day, count(*) AS n FROM (SELECT deal_id, min(ist_day) AS ist_day FROM e GROUP BY deal_id) GROUP BY ist_day) SELECT coalesce(s.ist_day, n.ist_day) AS ist_day, coalesce(sourced, 0) AS sourced, coalesce(n.n, 0) AS new_deals FROM n FULL JOIN s ON n.ist_day = s.ist_day")
def _(w):
    return mt.leads_assigned(w.x)


OCC = f"occ AS (SELECT CASE WHEN rung = 'UNMAPPED' THEN 'unmapped' WHEN rung = 'DEAD' THEN 'dead' WHEN rung = 'WON' THEN 'won' ELSE 'live' END AS state, rung, reason, count(*) AS deals FROM (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at DESC, event_id DESC) AS r FROM x WHERE ist_day <= DATE '{DAY}') WHERE r = 1 AND deal_id NOT IN (SELECT deal_id FROM d WHERE is_archived AND coalesce(archived_day <= DATE '{DAY}', true)) GROUP BY ALL)"


@query("occupancy_at", f", {OCC} SELECT * FROM occ")
def _(w):
    return mt.occupancy_at(w.x, w.deals, DAY)


def _by_day(w):
    """The events with their rungs as a table that is parted by day, 25 days earlier so that they span the end of a month, and a folder for checkpoints."""
    path = scratch_path(w.spark, "events-by-day")
    x = w.x.select("deal_id", "event_id", "entered_at", "rung", "reason", F.date_sub("ist_day", 25).alias("ist_day"))
    write_days(x, path)
    return w.spark.read.schema(x.schema).parquet(path), scratch_path(w.spark, "state-checkpoints")


SHIFTED = "sx AS (SELECT deal_id, event_id, entered_at, rung, reason, ist_day - 25 AS ist_day FROM x)"


@query("occupancy_replayed", f", {SHIFTED}, l AS (SELECT deal_id, arg_max(rung, (entered_at, event_id)) AS rung, arg_max(coalesce(reason, '-'), (entered_at, event_id)) AS reason FROM sx WHERE ist_day <= DATE '{DAY}' - 15 GROUP BY deal_id) SELECT CASE rung WHEN 'UNMAPPED' THEN 'unmapped' WHEN 'DEAD' THEN 'dead' WHEN 'WON' THEN 'won' ELSE 'live' END AS state, rung, nullif(reason, '-') AS reason, count(*) AS deals FROM l JOIN d ON d.deal_id = l.deal_id WHERE NOT is_archived OR archived_day > DATE '{DAY}' - 15 GROUP BY ALL")
def _(w):
    events, path = _by_day(w)
    oc.write_checkpoints(events, path, DAY)
    return oc.occupancy_on(events, path, w.deals, w.deals, str(dt.date.fromisoformat(DAY) - dt.timedelta(days=15)), DAY)


@query("occupancy_live", " SELECT CASE WHEN rung IS NULL THEN 'unmapped' WHEN rung = 'DEAD' THEN 'dead' WHEN rung = 'WON' THEN 'won' ELSE 'live' END AS state, coalesce(rung, 'UNMAPPED') AS rung, reason, count(*) AS deals FROM d LEFT JOIN sm ON d.stage_id = sm.stage_id WHERE NOT is_archived GROUP BY ALL")
def _(w):
    at = w.stages.select(F.col("stage_id").alias("_s"), "rung", "reason")
    live = w.deals.join(F.broadcast(at), w.deals["stage_id"] == at["_s"], "left").select("deal_id", F.coalesce("rung", F.lit("UNMAPPED")).alias("rung"), "reason")
    return oc.occupancy_on(w.x, "", w.deals, live, DAY, DAY)


DERIVED = """o AS (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at, event_id) AS i FROM x),
an AS (SELECT deal_id, min(i) FILTER (rung = 'MEETING_BOOKED') AS b, min(i) FILTER (rung = 'ASSET_RECEIVED') AS a, min(ist_day) FILTER (reason IN ('NO_SHOW', 'MEETING_CANCELLED')) AS bad FROM o GROUP BY deal_id),
h AS (SELECT o.deal_id, min(o.i) AS i FROM o JOIN an ON o.deal_id = an.deal_id WHERE o.i > b AND ((rung NOT IN ('DEAD', 'UNMAPPED') AND depth >= 6) OR (rung = 'DEAD' AND depth_reached >= 5 AND reason IN ('REJECTED', 'NOT_INTERESTED', 'PRIVACY'))) GROUP BY o.deal_id),
v AS (SELECT o.deal_id, min(o.i) AS i FROM o JOIN an ON o.deal_id = an.deal_id WHERE o.i > a AND ((rung NOT IN ('DEAD', 'UNMAPPED') AND depth >= 9) OR (rung = 'DEAD' AND depth_reached >= 8)) GROUP BY o.deal_id),
dr AS (SELECT h.deal_id, 'MEETING_HELD' AS rung, ob.ist_day AS credit_day, oe.ist_day AS evidence_day FROM h JOIN an ON h.deal_id = an.deal_id JOIN o ob ON ob.deal_id = h.deal_id AND ob.i = an.b JOIN o oe ON oe.deal_id = h.deal_id AND oe.i = h.i WHERE bad IS NULL OR bad > oe.ist_day
UNION ALL SELECT v.deal_id, 'EVALUATED', oe.ist_day, oe.ist_day FROM v JOIN o oe ON oe.deal_id = v.deal_id AND oe.i = v.i)"""


@query("derived_rungs", f", {DERIVED} SELECT * FROM dr")
def _(w):
    return mt.derived_rungs(w.x, model.HELD_REASONS)


@query("dead_breakdown", f", {OCC}, c AS (SELECT reason, count(DISTINCT {ANY} || ist_day) FILTER ({IN1}) AS today, count(DISTINCT {ANY} || ist_day) FILTER ({IN7}) AS roll7, count(DISTINCT deal_id) AS inception FROM x WHERE reason IS NOT NULL AND ist_day <= DATE '{DAY}' GROUP BY reason) SELECT c.*, coalesce(n.now, 0) AS now FROM c LEFT JOIN (SELECT reason, CAST(sum(deals) AS BIGINT) AS now FROM occ GROUP BY reason) n ON c.reason = n.reason")
def _(w):
    return mt.dead_breakdown(w.x, w.deals, DAY)


@query("owner_rows", f"SELECT actor, count(*) FILTER ({IN1}) AS moves, count(DISTINCT deal_id) FILTER ({IN1}) AS engaged, count(DISTINCT deal_id) FILTER ({IN7}) AS engaged7 FROM e WHERE is_human AND ist_day <= DATE '{DAY}' GROUP BY actor")
def _(w):
    return mt.owner_rows(w.events, DAY)


@query("rung_funnel_matrix", "SELECT rung, " + ", ".join(f"count(DISTINCT deal_id) FILTER (pipeline_id = {p}) AS p{p}" for p in range(5)) + " FROM x GROUP BY rung")
def _(w):
    return mt.matrix(w.x, list(range(5)))


@query("facts_engaged_daily", "SELECT ist_day, pipeline_id, count(*) AS deals FROM (SELECT *, row_number() OVER (PARTITION BY deal_id, ist_day ORDER BY entered_at DESC, event_id DESC) AS r FROM e WHERE is_human) WHERE r = 1 GROUP BY ist_day, pipeline_id")
def _(w):
    return mt.daily_facts(w.x)


@query("effort_entries", f"SELECT ist_day, count(DISTINCT {ANY}) FILTER (attempt) AS attempted, count(DISTINCT {ANY}) FILTER (connected) AS connected, count(DISTINCT {ANY}) FILTER (interested) AS interested FROM x GROUP BY ist_day")
def _(w):
    return mt.effort_entries(w.x)


@query("deals_entered", f", k AS (SELECT deal_id, is_human, ist_day, unnest([CAST(pipeline_id AS VARCHAR), 'ALL']) AS funnel, rung, stage_id, reason FROM x WHERE {IN7}), l AS (SELECT *, 'c' AS level, rung AS key FROM k UNION ALL SELECT *, 's', stage_id FROM k UNION ALL SELECT *, 'r', reason FROM k WHERE reason IS NOT NULL) SELECT funnel, level, key, count(DISTINCT deal_id) FILTER ({IN1}) AS today, count(DISTINCT deal_id) FILTER ({IN1} AND is_human) AS today_human, count(DISTINCT deal_id) AS roll7, count(DISTINCT deal_id) FILTER (is_human) AS roll7_human FROM l GROUP BY ALL")
def _(w):
    return mt.deals_entered(w.x, DAY)


@query("metric_values", f""", {OCC}, {COHORT}, {DERIVED}, hd AS (SELECT DISTINCT deal_id, ist_day FROM e WHERE is_human), hf AS (SELECT deal_id, min(ist_day) AS ist_day FROM hd GROUP BY deal_id), hb AS (SELECT deal_id, min(ist_day) AS bad_day FROM x WHERE reason = 'BAD_CONTACT' GROUP BY deal_id)
SELECT 'stage_entries' AS metric, rung AS key, count(DISTINCT {ANY} || ist_day) AS value FROM x WHERE {IN7} GROUP BY rung
UNION ALL SELECT 'deals_entered', rung, count(DISTINCT deal_id) FROM x WHERE {IN7} GROUP BY rung
UNION ALL SELECT 'inception', rung, count(DISTINCT deal_id) FROM x WHERE ist_day <= DATE '{DAY}' GROUP BY rung
UNION ALL SELECT 'inception_in_scope', rung, count(DISTINCT deal_id) FROM x WHERE ist_day <= DATE '{DAY}' AND deal_id IN (SELECT deal_id FROM co WHERE in_scope) GROUP BY rung
UNION ALL SELECT 'leads_assigned', 'sourced', count(DISTINCT {ANY}) FROM x WHERE {IN1} AND rung = 'SOURCED'
UNION ALL SELECT 'leads_assigned', 'new_deals', count(*) FROM (SELECT deal_id, min(ist_day) AS ist_day FROM e GROUP BY deal_id) WHERE {IN1}
UNION ALL SELECT 'engaged_daily', 'engaged', count(*) FROM hd WHERE {IN1}
UNION ALL SELECT 'engaged_7d', 'engaged', count(DISTINCT deal_id) FROM hd WHERE {IN7}
UNION ALL SELECT 'net_new_engaged', 'net_new', count(*) FROM hf LEFT JOIN hb ON hf.deal_id = hb.deal_id WHERE {IN1} AND (bad_day IS NULL OR bad_day > ist_day)
UNION ALL SELECT 'occupancy_now', state, CAST(sum(deals) AS BIGINT) FROM occ GROUP BY state
UNION ALL SELECT 'dead_by_reason', r.reason, CAST(coalesce((SELECT sum(deals) FROM occ WHERE occ.reason = r.reason), 0) AS BIGINT) FROM (SELECT DISTINCT reason FROM x WHERE reason IS NOT NULL AND ist_day <= DATE '{DAY}') r
UNION ALL SELECT CASE rung WHEN 'EVALUATED' THEN 'evaluated' ELSE 'meeting_held' END, rung, count(*) FROM dr WHERE evidence_day <= DATE '{DAY}' GROUP BY rung
UNION ALL SELECT 'won_to_date', rung, count(DISTINCT deal_id) FROM x WHERE ist_day <= DATE '{DAY}' AND rung = 'WON' GROUP BY rung
UNION ALL SELECT 'contracts_signed_7d', rung, count(DISTINCT {ANY} || ist_day) FROM x WHERE {IN7} AND rung = 'CONTRACT' AND is_human GROUP BY rung""")
def _(w):
    return mt.metric_values(mt.Frames(w.events, w.x, w.deals, ev.cohort(w.events, w.deals, "2024-01-03", "2024-01-05"), model.HELD_REASONS), DAY)


@query("day_status", f", {CAL}, t AS (SELECT cal.ist_day, count(e.event_id) AS total FROM cal LEFT JOIN e ON cal.ist_day = e.ist_day GROUP BY cal.ist_day), b AS (SELECT coalesce(quantile_cont(total, 0.5), 0) AS base FROM t WHERE isodow(ist_day) < 6 AND total > 0 AND ist_day BETWEEN DATE '{DAY}' - 14 AND DATE '{DAY}' - 1) SELECT ist_day, total, CASE WHEN ist_day = DATE '{DAY}' THEN 'partial' WHEN isodow(ist_day) >= 6 THEN CASE WHEN total = 0 THEN 'weekend' ELSE 'ok' END WHEN base > 0 AND total < 0.05 * base THEN 'gap' ELSE 'ok' END AS status FROM t, b")
def _(w):
    return mt.day_status(w.events, w.days, DAY, complete=False)


RULES = [("Early", "click_0", None), ("Early", "click_1", None), ("All views", None, "view_"), ("Won", "purchase_1", None), ("Purchases", None, "purchase")]


@query("vertical_stage_table", f", ru AS ({model.values_sql(RULES, 'row_name, stage, prefix')}), j AS (SELECT ru.row_name, e.deal_id, e.ist_day, e.deal_id || ':' || e.ist_day AS k FROM e JOIN ru ON ru.stage = e.stage_id OR starts_with(e.stage_id, ru.prefix) WHERE ist_day <= DATE '{DAY}') SELECT row_name, count(DISTINCT k) FILTER ({IN1}) AS today, count(DISTINCT k) FILTER ({IN7}) AS roll7, count(DISTINCT k) FILTER ({INP}) AS prev7, count(DISTINCT deal_id) AS inception FROM j GROUP BY row_name")
def _(w):
    return mt.vertical_rows(w.events, w.spark.sql(model.values_sql(RULES, "row_name, stage, prefix")), DAY)


@query("change_flags", f", {CAL}, c AS (SELECT ist_day, count(*) AS n FROM e GROUP BY ist_day), p AS (SELECT ist_day, n, lag(n) OVER (ORDER BY ist_day) AS b FROM c) SELECT ist_day, n - b AS delta, CASE WHEN b = 0 AND n > 0 THEN 'new' WHEN b = 0 AND n = 0 THEN 'flat' WHEN ist_day = DATE '2024-01-31' THEN 'partial' WHEN b >= 10 THEN 'pct' ELSE 'abs' END AS flag, CASE WHEN ist_day <> DATE '2024-01-31' AND b >= 10 THEN round((n - b) * 100.0::DOUBLE / b, 1) END AS pct FROM p WHERE b IS NOT NULL")
def _(w):
    daily = w.events.groupBy("ist_day").agg(F.count("*").alias("n"))
    rows = daily.withColumn("b", F.lag("n").over(Window.orderBy("ist_day"))).filter("b IS NOT NULL")  # a row a day
    return rows.withColumn("c", change(F.col("b"), F.col("n"), F.col("ist_day") != F.lit("2024-01-31").cast("date"))).select("ist_day", "c.delta", "c.flag", "c.pct")


@query("crosscheck", """, s AS (SELECT ist_day, count(DISTINCT CASE WHEN is_human OR event_id % 2 = 0 THEN deal_id END) AS old FROM (SELECT *, CASE WHEN day(ist_day) % 4 = 0 THEN true END AS a FROM e) WHERE day(ist_day) % 2 = 0 GROUP BY ist_day UNION ALL SELECT ist_day, count(DISTINCT CASE WHEN is_human THEN deal_id END) FROM e WHERE day(ist_day) % 2 = 1 GROUP BY ist_day),
h AS (SELECT r, m, hu FROM (VALUES (0, 330, false), (1, 330, true), (2, 0, false), (3, 0, true)) AS t(r, m, hu)),
v AS (SELECT CAST(entered_at + to_minutes(m) AS DATE) AS ist_day, r, count(DISTINCT deal_id) AS v FROM e, h WHERE NOT hu OR is_human GROUP BY ALL)
SELECT s.ist_day, old, coalesce(max(v) FILTER (r = 0), 0) AS new, coalesce(max(v) FILTER (r = 0), 0) - old AS delta, min(r) FILTER (v = old) AS hypothesis FROM s LEFT JOIN v ON s.ist_day = v.ist_day GROUP BY s.ist_day, old""")
def _(w):
    even = (F.dayofmonth("ist_day") % 2) == 0
    counted = F.when(F.col("is_human") | (even & (F.col("event_id") % 2 == 0)), F.col("deal_id"))
    snapshot = w.events.groupBy("ist_day").agg(F.countDistinct(counted).alias("old"))
    return mt.crosscheck(w.events, snapshot, [330, 0])


@query("trend_series", f", {CAL}, t AS (SELECT rung, ist_day, {PAIRS} FROM x GROUP BY rung, ist_day) SELECT r.rung, cal.ist_day, coalesce(t.entries_total, 0) AS entries FROM (SELECT DISTINCT rung FROM x) r CROSS JOIN (SELECT * FROM cal WHERE ist_day BETWEEN DATE '{DAY}' - 13 AND DATE '{DAY}') cal LEFT JOIN t ON t.rung = r.rung AND t.ist_day = cal.ist_day")
def _(w):
    days = w.days.filter(mt.within(DAY, 13, 0))
    grid = w.x.select("rung").distinct().crossJoin(F.broadcast(days))
    return grid.join(ev.entries(w.x, ["rung", "ist_day"]), ["rung", "ist_day"], "left").select("rung", "ist_day", F.coalesce("entries_total", F.lit(0)).alias("entries"))


@query("reassign_events", "SELECT CASE WHEN deal_id % 7 = 0 THEN 9 ELSE pipeline_id END AS pipeline_id, CASE WHEN deal_id % 7 = 0 AND stage_id = 'click_0' THEN 'moved_0' ELSE stage_id END AS stage_id, count(*) AS n FROM e GROUP BY ALL")
def _(w):
    moved = w.deals.filter("deal_id % 7 = 0").select("deal_id", F.lit(9).alias("to_pipeline"))
    labels = w.spark.sql("SELECT 'click_0' AS stage_id, 'moved_0' AS to_stage")
    home = w.events.join(moved, "deal_id", "left_anti").select("pipeline_id", "stage_id")
    away = w.events.join(moved, "deal_id").join(F.broadcast(labels), "stage_id", "left").select(F.col("to_pipeline").cast("long").alias("pipeline_id"), F.coalesce("to_stage", "stage_id").alias("stage_id"))
    return home.unionByName(away).groupBy("pipeline_id", "stage_id").agg(F.count("*").alias("n"))


@query("owner_stage_snapshot", " SELECT q.day AS snapshot_day, account_id, pipeline_id, owner, stage_id, count(*) AS deals FROM d, (VALUES (DATE '2024-01-19', 0), (DATE '2024-01-20', 1)) AS q(day, odd) WHERE NOT is_archived AND deal_id % 2 = odd GROUP BY ALL")
def _(w):
    path = scratch_path(w.spark, "owner-stages")
    for d, deals in (("2024-01-19", w.deals.filter("deal_id % 2 = 0")), ("2024-01-20", w.deals), ("2024-01-20", w.deals.filter("deal_id % 2 = 1"))):  # a day that is taken again replaces itself
        write_days(mt.owner_stages(deals, d), path, "snapshot_day")
    return w.spark.read.parquet(path)


@query("integrity", "SELECT account_id, max(entered_at) AS newest, date_diff('hour', max(entered_at), TIMESTAMP '2024-02-01 00:00:00') AS hours_ago, count(DISTINCT ist_day) AS days, count(*) FILTER (rung = 'UNMAPPED') AS unmapped FROM x GROUP BY account_id")
def _(w):
    hours = F.expr("cast(date_trunc('HOUR', TIMESTAMP_NTZ '2024-02-01 00:00:00') as timestamp_ntz)")
    rows = w.x.groupBy("account_id").agg(F.max("entered_at").alias("newest"), F.countDistinct("ist_day").alias("days"), F.count_if(F.col("rung") == "UNMAPPED").alias("unmapped"))
    return rows.withColumn("hours_ago", F.timestamp_diff("HOUR", F.date_trunc("HOUR", "newest"), hours))
