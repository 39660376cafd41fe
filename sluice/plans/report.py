"""Queries of the funnel report's tables over the given events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.operators import events as ev
from sluice.operators import metrics as mt
from sluice.operators import report as rp
from sluice.plans import model
from sluice.plans.funnel import ANY, CAL, COHORT, DAY, PAIRS, World
from sluice.plans.model import funnel_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Every native stage; error_3 and moved_0 are tombstones, error_3 an alias of error_0, click_3 keeps its own mapping though it is one.
STAGES = [(f"{t}_{k}", (t, k) == ("error", 3)) for t in ("click", "view", "signup", "purchase", "error") for k in range(4)] + [("moved_0", True)]
ALIASES = [("error_3", "error_0"), ("click_3", "click_1"), ("moved_0", "nowhere")]
LISTS = f"st AS ({model.values_sql(STAGES, 'stage_id, is_deleted')}), al AS ({model.values_sql(ALIASES, 'stage_id, to_stage')})"
SE = """se AS (SELECT st.stage_id, st.is_deleted, coalesce(al.to_stage, st.stage_id) AS group_stage, al.to_stage AS via_alias, sm.stage_id IS NOT NULL AS is_mapped, sm.rung, sm.reason, sm.depth_reached, rg.depth,
coalesce(sm.own_attempt, rs.attempt, rg.attempt, false) AS attempt, coalesce(rs.connected, rg.connected, false) AS connected, coalesce(rg.interested, false) AS interested
FROM st LEFT JOIN al ON al.stage_id = st.stage_id LEFT JOIN sm ON sm.stage_id = CASE WHEN EXISTS (SELECT 1 FROM sm o WHERE o.stage_id = st.stage_id) THEN st.stage_id ELSE al.to_stage END LEFT JOIN rg ON sm.rung = rg.code LEFT JOIN rs ON sm.reason = rs.code)"""
OWN = "ow AS (SELECT deal_id, actor AS owner, entered_at AS assigned_at, ist_day, event_id FROM e WHERE actor IS NOT NULL AND event_id % 5 = 0)"
STATE = f"sx AS (SELECT deal_id, rung, reason, stage_id, pipeline_id FROM (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at DESC, event_id DESC) AS r FROM x WHERE ist_day <= DATE '{DAY}') WHERE r = 1), sa AS (SELECT sx.*, d.owner, d.lead_source FROM sx JOIN d ON d.deal_id = sx.deal_id WHERE NOT d.is_archived OR d.archived_day > DATE '{DAY}')"
NEW = "nn AS (SELECT f.deal_id, f.ist_day, f.actor FROM (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY entered_at, event_id) AS r FROM e WHERE is_human) f LEFT JOIN (SELECT deal_id, min(ist_day) AS bad FROM x WHERE reason = 'BAD_CONTACT' GROUP BY deal_id) b ON b.deal_id = f.deal_id WHERE r = 1 AND (bad IS NULL OR bad > f.ist_day))"


def query(name: str, body: str):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(World(spark, sf_dir))
        SQL[name] = funnel_sql(f", {LISTS}, {SE}, {OWN}, {STATE}, {NEW} {body}")
        return f

    return add


def _stages(w):
    lists = w.spark.sql(model.values_sql(STAGES, "stage_id, is_deleted")), w.spark.sql(model.values_sql(ALIASES, "stage_id, to_stage"))
    return ev.effective_stages(model.stage_map(w.spark), model.rungs(w.spark), model.reasons(w.spark), *lists)


def _owners(w):
    return w.events.filter("actor IS NOT NULL AND event_id % 5 = 0").select("deal_id", F.col("actor").alias("owner"), F.col("entered_at").alias("assigned_at"), "ist_day")


@query("stage_effective_alias", "SELECT se.*, n.events FROM se LEFT JOIN (SELECT stage_id, count(*) AS events FROM e GROUP BY stage_id) n ON n.stage_id = se.stage_id")
def _(w):
    return _stages(w).join(w.events.groupBy("stage_id").agg(F.count("*").alias("events")), "stage_id", "left")


@query("native_group_entries", f"SELECT group_stage, ist_day, {PAIRS} FROM (SELECT e.*, se.group_stage FROM e JOIN se ON se.stage_id = e.stage_id) GROUP BY group_stage, ist_day")
def _(w):
    return ev.entries(w.events.join(F.broadcast(_stages(w).select("stage_id", "group_stage")), "stage_id"), ["group_stage", "ist_day"])


@query("funnel_canonical_counts", "SELECT p.pipeline_id, coalesce(se.rung, 'UNMAPPED') AS rung, coalesce(se.reason, '') AS reason, count(d.deal_id) AS deals FROM (SELECT DISTINCT pipeline_id FROM d) p CROSS JOIN se LEFT JOIN d ON d.pipeline_id = p.pipeline_id AND d.stage_id = se.stage_id AND NOT d.is_archived WHERE NOT se.is_deleted OR d.deal_id IS NOT NULL GROUP BY ALL")
def _(w):
    return rp.counts_now(w.deals, _stages(w), ["rung", "reason"])


@query("coverage_days", f", {CAL}, sy AS (SELECT account_id, max(ist_day) - CAST(account_id * 3 AS INT) AS synced_day FROM e GROUP BY account_id) SELECT ist_day, ist_day >= DATE '2024-01-03' AND ist_day <= (SELECT min(synced_day) FROM sy) AND ist_day <= DATE '2024-01-30' AS covered FROM cal")
def _(w):
    syncs = w.events.groupBy("account_id").agg(F.max("ist_day").alias("m")).select("account_id", F.date_sub("m", (F.col("account_id") * 3).cast("int")).alias("synced_day"))
    return rp.coverage(w.days, mt.day("2024-01-03"), syncs, "2024-01-30")


WIN = f"count(DISTINCT {ANY} || ist_day) FILTER (ist_day = DATE '{DAY}') AS today, count(DISTINCT {ANY} || ist_day) FILTER (ist_day = DATE '{DAY}' - 1) AS yesterday, count(DISTINCT {ANY} || ist_day) FILTER (ist_day BETWEEN DATE '{DAY}' - 6 AND DATE '{DAY}') AS roll7, count(DISTINCT {ANY} || ist_day) FILTER (ist_day BETWEEN DATE '{DAY}' - 13 AND DATE '{DAY}' - 7) AS prev7, count(DISTINCT deal_id) AS inception"


def rows_sql(source: str, dimension: str, key: str, columns: str) -> str:
    return f", w AS (SELECT {key}, {WIN} FROM {source} WHERE ist_day <= DATE '{DAY}' GROUP BY {key}), n AS (SELECT {key}, count(*) AS now FROM {'sg' if key == 'group_stage' else 'sa'} GROUP BY {key}) SELECT {columns}, coalesce(now, 0) AS now, coalesce(today, 0) AS today, coalesce(yesterday, 0) AS yesterday, coalesce(roll7, 0) AS roll7, coalesce(prev7, 0) AS prev7, coalesce(inception, 0) AS inception FROM {dimension} g LEFT JOIN w ON w.{key} = g.{key} LEFT JOIN n ON n.{key} = g.{key}"


def _now(w, key):
    return rp.states_at(w.x, w.deals, DAY).groupBy(key).agg(F.count("*").alias("now"))


@query("canonical_rows", rows_sql("x", "(SELECT code AS rung, depth FROM rg UNION ALL SELECT 'UNMAPPED', NULL)", "rung", "g.rung, g.depth"))
def _(w):
    dimension = model.rungs(w.spark).select(F.col("code").alias("rung"), "depth").unionByName(w.spark.sql("SELECT 'UNMAPPED' AS rung, CAST(NULL AS DOUBLE) AS depth"))
    return rp.report_rows(w.x, _now(w, "rung"), dimension, "rung", DAY)


@query("dead_rows", rows_sql("x", "(SELECT code AS reason FROM rs)", "reason", "g.reason"))
def _(w):
    return rp.report_rows(w.x.filter("reason IS NOT NULL"), _now(w, "reason"), model.reasons(w.spark).select(F.col("code").alias("reason")), "reason", DAY)


@query("native_rows", ", sg AS (SELECT sa.*, se.group_stage FROM sa JOIN se ON se.stage_id = sa.stage_id), xg AS (SELECT x.*, se.group_stage FROM x JOIN se ON se.stage_id = x.stage_id), gs AS (SELECT stage_id AS group_stage, coalesce(rung, 'UNMAPPED') AS rung, is_deleted FROM se WHERE group_stage = stage_id)" + rows_sql("xg", "gs", "group_stage", "g.group_stage, g.rung, g.is_deleted"))
def _(w):
    stages = _stages(w)
    to = F.broadcast(stages.select("stage_id", "group_stage"))
    now = rp.states_at(w.x, w.deals, DAY).join(to, "stage_id").groupBy("group_stage").agg(F.count("*").alias("now"))
    dimension = stages.filter("group_stage = stage_id").select("group_stage", F.coalesce("rung", F.lit("UNMAPPED")).alias("rung"), "is_deleted")
    return rp.report_rows(w.x.join(to, "stage_id"), now, dimension, "group_stage", DAY)


@query("owner_report", f", a AS (SELECT actor AS owner_id, count(DISTINCT deal_id || ':' || stage_id) FILTER (ist_day = DATE '{DAY}') AS moves, count(DISTINCT deal_id) FILTER (ist_day = DATE '{DAY}') AS engaged, count(DISTINCT deal_id) AS engaged7 FROM e WHERE is_human AND actor IS NOT NULL AND ist_day BETWEEN DATE '{DAY}' - 6 AND DATE '{DAY}' GROUP BY actor), n AS (SELECT actor AS owner_id, count(*) AS net_new FROM nn WHERE ist_day = DATE '{DAY}' AND actor IS NOT NULL GROUP BY actor), g AS (SELECT owner AS owner_id, count(*) AS assigned FROM ow WHERE ist_day = DATE '{DAY}' GROUP BY owner), lo AS (SELECT deal_id, owner FROM (SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY assigned_at DESC, owner DESC) AS r FROM ow WHERE ist_day <= DATE '{DAY}') WHERE r = 1), h AS (SELECT coalesce(lo.owner, sa.owner) AS owner_id, count(*) AS now, count(*) FILTER (rung NOT IN ('DEAD', 'WON')) AS live, count(*) FILTER (rung = 'DEAD') AS dead, count(*) FILTER (rung = 'WON') AS won FROM sa LEFT JOIN lo ON lo.deal_id = sa.deal_id GROUP BY 1), k AS (SELECT owner_id FROM a UNION SELECT owner_id FROM n UNION SELECT owner_id FROM g UNION SELECT owner_id FROM h) SELECT CAST(k.owner_id AS BIGINT) AS owner_id, coalesce(moves, 0) AS moves, coalesce(engaged, 0) AS engaged, coalesce(engaged7, 0) AS engaged7, coalesce(net_new, 0) AS net_new, coalesce(assigned, 0) AS assigned, coalesce(now, 0) AS now, coalesce(live, 0) AS live, coalesce(dead, 0) AS dead, coalesce(won, 0) AS won FROM k LEFT JOIN a ON a.owner_id = k.owner_id LEFT JOIN n ON n.owner_id = k.owner_id LEFT JOIN g ON g.owner_id = k.owner_id LEFT JOIN h ON h.owner_id IS NOT DISTINCT FROM k.owner_id")
def _(w):
    return rp.owner_report(w.x, w.deals, _owners(w), DAY)


@query("facts_funnel_daily", f", {COHORT}, f AS (SELECT x.*, 'all' AS scope FROM x UNION ALL SELECT x.*, 'in_scope' FROM x WHERE deal_id IN (SELECT deal_id FROM co WHERE in_scope)) SELECT ist_day, pipeline_id, stage_id, scope, {PAIRS} FROM f GROUP BY ist_day, pipeline_id, stage_id, scope")
def _(w):
    return rp.funnel_facts(w.x, ev.cohort(w.events, w.deals, "2024-01-03", "2024-01-05").filter("in_scope"))


@query("facts_owner_daily", "SELECT ist_day, CAST(actor AS BIGINT) AS actor, 'stage_entry' AS kind, rung AS code, count(DISTINCT deal_id) FILTER (is_human) AS human, count(DISTINCT deal_id) FILTER (NOT is_human) AS auto, count(DISTINCT deal_id) AS deals FROM x GROUP BY ist_day, actor, rung UNION ALL SELECT ist_day, actor, 'engaged', NULL, count(DISTINCT deal_id || ':' || stage_id), 0, count(DISTINCT deal_id) FROM e WHERE is_human AND actor IS NOT NULL GROUP BY ist_day, actor UNION ALL SELECT ist_day, actor, 'net_new', NULL, count(*), 0, count(*) FROM nn WHERE actor IS NOT NULL GROUP BY ist_day, actor UNION ALL SELECT ist_day, owner, 'assigned', NULL, 0, count(*), count(DISTINCT deal_id) FROM ow GROUP BY ist_day, owner")
def _(w):
    return rp.owner_facts(w.x, _owners(w))


@query("empty_days", f", ev AS (SELECT * FROM e WHERE day(ist_day) % 6 <> 0), {CAL} SELECT ist_day, isodow(ist_day) >= 6 AS weekend FROM cal WHERE ist_day BETWEEN DATE '{DAY}' - 13 AND DATE '{DAY}' AND ist_day NOT IN (SELECT ist_day FROM ev)")
def _(w):
    return rp.empty_days(w.days, w.events.filter("dayofmonth(ist_day) % 6 <> 0"), DAY, 14)


@query("archived_counts", "SELECT pipeline_id, count(*) FILTER (is_archived) AS archived, count(*) AS deals, count(*) FILTER (NOT is_archived) AS live, count(*) FILTER (owner IS NULL AND NOT is_archived) AS without_owner FROM d GROUP BY pipeline_id")
def _(w):
    return w.deals.groupBy("pipeline_id").agg(F.count_if("is_archived").alias("archived"), F.count("*").alias("deals"), F.count_if(~F.col("is_archived")).alias("live"), F.count_if(F.col("owner").isNull() & ~F.col("is_archived")).alias("without_owner"))


@query("anchor_checks", "SELECT coalesce(x.pipeline_id, n.pipeline_id) AS pipeline_id, expected, coalesce(actual, 0) AS actual, coalesce(expected = coalesce(actual, 0), false) AS ok FROM (VALUES (0::BIGINT, 20::BIGINT), (1, 21), (9, 0)) AS x(pipeline_id, expected) FULL JOIN (SELECT pipeline_id, count(*) AS actual FROM d WHERE NOT is_archived GROUP BY pipeline_id) n ON n.pipeline_id = x.pipeline_id")
def _(w):
    expected = w.spark.sql("SELECT * FROM VALUES (0L, 20L), (1L, 21L), (9L, 0L) AS v(pipeline_id, expected)")
    return rp.anchors(w.deals.filter("NOT is_archived").groupBy("pipeline_id").agg(F.count("*").alias("actual")), expected, "pipeline_id")


@query("legacy_snapshot_rows", "SELECT snapshot, metric, label, value FROM (SELECT ist_day || ':' || pipeline_id AS snapshot, 'flow' AS metric, stage_id AS label, CAST(count(*) AS DOUBLE) AS value FROM e GROUP BY ALL UNION ALL SELECT ist_day || ':' || pipeline_id, 'state', 'deals', CAST(count(DISTINCT deal_id) AS DOUBLE) FROM e GROUP BY ALL)")
def _(w):
    flow = w.events.groupBy("ist_day", "pipeline_id", "stage_id").agg(F.count("*").alias("n")).groupBy("ist_day", "pipeline_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("stage_id", "n")))).alias("flow"))
    state = w.events.groupBy("ist_day", "pipeline_id").agg(F.to_json(F.struct(F.countDistinct("deal_id").alias("deals"))).alias("state"))
    rows = flow.join(state, ["ist_day", "pipeline_id"]).withColumn("snapshot", F.concat_ws(":", F.col("ist_day").cast("string"), F.col("pipeline_id").cast("string")))
    return rp.snapshot_rows(rows, ["flow", "state"])


ROWS = [("Early", "click_0", None, None), ("Early", "click_1", None, None), ("All views", None, "view_", "2024-01-10"), ("Won", "purchase_1", None, None), ("Purchases", None, "purchase", None)]
STATUS = f"{CAL}, dt AS (SELECT cal.ist_day, count(e.event_id) AS total FROM cal LEFT JOIN e ON cal.ist_day = e.ist_day GROUP BY cal.ist_day), ds AS (SELECT ist_day, CASE WHEN isodow(ist_day) >= 6 THEN 'ok' WHEN day(ist_day) % 5 = 0 THEN 'gap' ELSE 'ok' END AS status FROM dt)"


@query("vertical_report", f", {STATUS}, ru AS (SELECT row_name, stage, prefix, CAST(inception_from AS DATE) AS inception_from FROM ({model.values_sql(ROWS, 'row_name, stage, prefix, inception_from')})), j AS (SELECT DISTINCT ru.row_name, inception_from, deal_id, e.ist_day, is_human, status = 'ok' AS c FROM e JOIN ru ON ru.stage = e.stage_id OR starts_with(e.stage_id, ru.prefix) JOIN ds ON ds.ist_day = e.ist_day WHERE e.ist_day <= DATE '{DAY}') SELECT row_name, count(DISTINCT deal_id || ':' || ist_day) FILTER (ist_day = DATE '{DAY}') AS today, count(DISTINCT deal_id || ':' || ist_day) FILTER (c AND ist_day BETWEEN DATE '{DAY}' - 6 AND DATE '{DAY}') AS roll7, count(DISTINCT deal_id || ':' || ist_day) FILTER (c AND ist_day BETWEEN DATE '{DAY}' - 13 AND DATE '{DAY}' - 7) AS prev7, count(DISTINCT deal_id) FILTER (is_human AND ist_day BETWEEN DATE '{DAY}' - 6 AND DATE '{DAY}') AS engaged7, count(DISTINCT deal_id) FILTER (inception_from IS NULL OR ist_day >= inception_from) AS inception, (SELECT count(*) FROM ds WHERE status = 'ok' AND ist_day BETWEEN DATE '{DAY}' - 6 AND DATE '{DAY}') AS roll7_days, (SELECT count(*) FROM ds WHERE status = 'ok' AND ist_day BETWEEN DATE '{DAY}' - 13 AND DATE '{DAY}' - 7) AS prev7_days FROM j GROUP BY row_name")
def _(w):
    rules = w.spark.sql(model.values_sql(ROWS, "row_name, stage, prefix, inception_from")).withColumn("inception_from", F.col("inception_from").cast("date"))
    status = w.days.withColumn("status", F.when(F.weekday("ist_day") >= 5, "ok").when(F.dayofmonth("ist_day") % 5 == 0, "gap").otherwise("ok"))
    return rp.vertical_report(w.events, rules, status, DAY)


CHIPS = f", {CAL}, c AS (SELECT ist_day, count(*) AS n, CASE WHEN ist_day = DATE '{DAY}' THEN 'partial' WHEN isodow(ist_day) >= 6 THEN 'weekend' WHEN day(ist_day) % 7 = 0 THEN 'gap' ELSE 'ok' END AS status FROM e GROUP BY ist_day), p AS (SELECT *, lag(n) OVER (ORDER BY ist_day) AS b, lag(status) OVER (ORDER BY ist_day) AS sb, 7 - day(ist_day) % 3 AS dc FROM c)"


@query("change_chips", CHIPS + " SELECT ist_day, kind, CASE WHEN kind IN ('up', 'down') THEN CAST(abs(round_even(CASE WHEN dc <> 7 THEN (n * 7 - b * dc) * 100.0::DOUBLE / (b * dc) ELSE (n - b) * 100.0::DOUBLE / b END, 0)) AS INT) END AS pct, dc <> 7 AS per_day, CASE WHEN status = 'partial' THEN 'partial' WHEN sb = 'weekend' THEN 'weekend' WHEN sb = 'gap' OR b IS NULL THEN 'gap' WHEN n = b THEN 'flat' WHEN n > b THEN 'up' ELSE 'down' END AS daily FROM (SELECT *, CASE WHEN abs(n / dc::DOUBLE - b / 7::DOUBLE) < 1e-9 THEN 'flat' WHEN n / dc::DOUBLE > b / 7::DOUBLE THEN 'up' ELSE 'down' END AS kind FROM p WHERE b IS NOT NULL)")
def _(w):
    from pyspark.sql import Window

    daily = w.events.groupBy("ist_day").agg(F.count("*").alias("n"))
    daily = daily.withColumn("status", F.when(F.col("ist_day") == mt.day(DAY), "partial").when(F.weekday("ist_day") >= 5, "weekend").when(F.dayofmonth("ist_day") % 7 == 0, "gap").otherwise("ok"))
    order = Window.orderBy("ist_day")  # a row a day
    rows = daily.withColumns({"b": F.lag("n").over(order), "sb": F.lag("status").over(order), "dc": 7 - F.dayofmonth("ist_day") % 3}).filter("b IS NOT NULL")
    shown = rp.chip(F.col("n"), F.col("b"), F.col("dc"), F.lit(7))
    return rows.withColumns({"_c": shown, "_d": rp.daily_chip(F.col("n"), F.col("b"), F.col("status"), F.col("sb"))}).select("ist_day", "_c.kind", "_c.pct", "_c.per_day", F.col("_d.kind").alias("daily"))


MAPPED = [("Early", "click_0", None, False), ("Both", "click_0", None, False), ("Odd", "click_9", None, False), ("Part", None, "zzz_", False), ("Views", None, "view_", False), ("One", "view_1", None, True), ("Two", "view_1", None, True)]


@query("row_mapping_problems", f", ru AS ({model.values_sql(MAPPED, 'row_name, stage, prefix, overlap')}), k AS (SELECT DISTINCT stage_id FROM e) SELECT row_name, stage, 'missing' AS problem FROM ru WHERE stage IS NOT NULL AND stage NOT IN (SELECT stage_id FROM k) UNION ALL SELECT row_name, prefix, 'prefix_matches_none' FROM ru WHERE prefix IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE starts_with(stage_id, prefix)) UNION ALL SELECT array_to_string(list_sort(list(DISTINCT row_name)), '+'), stage, 'two_rows' FROM ru WHERE stage IS NOT NULL GROUP BY stage HAVING count(DISTINCT row_name) > 1 AND NOT bool_or(overlap)")
def _(w):
    return rp.row_problems(w.spark.sql(model.values_sql(MAPPED, "row_name, stage, prefix, overlap")), w.events.select("stage_id"))


@query("resolve_pipeline", ", hs AS (SELECT DISTINCT stage_id, CASE WHEN starts_with(stage_id, 'click') THEN 0 WHEN starts_with(stage_id, 'view') THEN pipeline_id // 2 ELSE pipeline_id END AS pipeline FROM e WHERE pipeline_id < 4 AND NOT starts_with(stage_id, 'signup')), ho AS (SELECT stage_id, list(DISTINCT pipeline) AS homes FROM hs GROUP BY stage_id), hi AS (SELECT deal_id, entered_at, max(pipeline_id) AS p FROM e WHERE event_id % 4 = 0 AND deal_id % 5 > 0 GROUP BY ALL), fi AS (SELECT deal_id, arg_min(p, entered_at) AS p FROM hi GROUP BY deal_id), r AS (SELECT e.event_id, ho.homes, coalesce(hi.p, fi.p) AS then_, CASE WHEN d.deal_id % 3 > 0 THEN d.pipeline_id % 2 END AS now_ FROM e ASOF LEFT JOIN hi ON hi.deal_id = e.deal_id AND e.entered_at >= hi.entered_at LEFT JOIN fi ON fi.deal_id = e.deal_id LEFT JOIN d ON d.deal_id = e.deal_id LEFT JOIN ho ON ho.stage_id = e.stage_id) SELECT event_id, CASE basis WHEN 'unique_stage_id' THEN homes[1] WHEN 'pipeline_history' THEN then_ WHEN 'deal_current' THEN now_ END AS pipeline, basis FROM (SELECT *, CASE WHEN len(homes) = 1 THEN 'unique_stage_id' WHEN homes IS NULL THEN CASE WHEN then_ IS NOT NULL THEN 'pipeline_history' WHEN now_ IS NOT NULL THEN 'deal_current' ELSE 'unresolved' END WHEN then_ IN (SELECT unnest(homes)) THEN 'pipeline_history' WHEN now_ IN (SELECT unnest(homes)) THEN 'deal_current' ELSE 'unresolved' END AS basis FROM r)")
def _(w):
    home = F.when(F.col("stage_id").startswith("click"), F.lit(0).cast("long")).when(F.col("stage_id").startswith("view"), F.floor(F.col("pipeline_id") / 2)).otherwise(F.col("pipeline_id"))
    stages = w.events.filter("pipeline_id < 4 AND NOT startswith(stage_id, 'signup')").select("stage_id", home.alias("pipeline")).distinct()
    history = w.events.filter("event_id % 4 = 0 AND deal_id % 5 > 0").select("deal_id", F.col("entered_at").alias("at"), F.col("pipeline_id").alias("pipeline"))
    return rp.resolve_pipeline(w.events.select("event_id", "deal_id", "stage_id", "entered_at"), stages, history, w.deals.select("deal_id", F.when(F.col("deal_id") % 3 > 0, F.col("pipeline_id") % 2).alias("pipeline")))


@query("cold_lead_sources", " SELECT CAST(row_number() OVER (ORDER BY CASE country WHEN 'GB' THEN 1 WHEN 'IN' THEN 2 ELSE 99 END, deals DESC, lead_source, country) AS INT) AS place, country, lead_source, deals FROM (SELECT CASE WHEN regexp_matches(lead_source, '(?i)india') THEN 'IN' WHEN regexp_matches(lead_source, '(?i)\\buk\\b') THEN 'GB' ELSE 'other' END AS country, coalesce(lead_source, '(none)') AS lead_source, count(*) AS deals FROM sa WHERE rung = 'SOURCED' GROUP BY ALL)")
def _(w):
    country = norm.first_match(F.col("lead_source"), [("india", "IN"), (r"\buk\b", "GB")], "other")
    return rp.lead_source_country(rp.states_at(w.x, w.deals, DAY), w.deals, "SOURCED", country, ["GB", "IN"])
