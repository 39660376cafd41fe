"""Queries that hold reported numbers against recomputed ones. The reports are derived from the events of five days, counted in another way each day."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.staging import staged
from sluice.operators import reconcile as rc
from sluice.plans import funnel
from sluice.plans.funnel import DAY
from sluice.plans.model import funnel_sql, values_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Rows of the reports: name, the stages in it (by prefix), and whether automatic moves count. Nothing is known of the last one.
LABELS = [("new", "click_0", True), ("second", "click_1", False), ("views", "view_", False), ("signups", "signup", False), ("gone", "nosuch", False)]
OWNERS = [(None,), (3,)]
EV = f"""ev AS (SELECT e.event_id, e.deal_id, e.ist_day, e.entered_at, e.stage_id AS stage, e.actor, e.is_human, d.is_archived, d.archived_day, d.owner AS owner_now, CASE WHEN day(e.ist_day) % 2 = 0 THEN d.owner ELSE e.deal_id % 10 END AS deal_owner, CAST((hour(e.entered_at) * 60 + minute(e.entered_at) + 330) % 1440 AS INT) AS m FROM e JOIN d ON e.deal_id = d.deal_id),
rw AS (SELECT k || ':' || label || ':' || coalesce(CAST(owner AS VARCHAR), '-') AS row_id, CAST(DATE '{DAY}' - CAST(k AS INT) AS DATE) AS ist_day, k, owner, any_source, prefix FROM range(5) AS q(k), ({values_sql(LABELS, "label, prefix, any_source")}), ({values_sql(OWNERS, "owner")})),
gr AS (SELECT DISTINCT row_id, stage FROM rw JOIN ev ON starts_with(stage, prefix))"""
ONCE = "deal_id || ':' || stage || ':' || coalesce(CAST(actor AS VARCHAR), '-') || is_human"
HYPS = values_sql([(i, h.cutoff, *[s in h.switches for s in rc.SWITCHES], h.name()) for i, h in enumerate(rc.FLOW)], "rank, cut, by_owner, raw, live, utc, name")
FLOWS = f"""{EV}, mt AS (SELECT rw.row_id, rw.k, rw.owner, ev.* FROM rw JOIN gr ON rw.row_id = gr.row_id JOIN ev ON ev.ist_day = rw.ist_day AND ev.stage = gr.stage WHERE is_human OR any_source),
od AS (SELECT rw.row_id, rw.k, rw.owner, CASE rw.k WHEN 0 THEN count(DISTINCT {ONCE}) WHEN 1 THEN count(event_id) WHEN 2 THEN count(DISTINCT {ONCE}) FILTER (m < 1110) WHEN 3 THEN count(DISTINCT {ONCE}) FILTER (NOT is_archived AND m >= 330) ELSE count(DISTINCT {ONCE}) + 7 END AS old
FROM rw LEFT JOIN mt ON mt.row_id = rw.row_id AND (rw.owner IS NULL OR CASE WHEN rw.k = 2 THEN deal_owner ELSE actor END = rw.owner) GROUP BY rw.row_id, rw.k, rw.owner),
hy AS ({HYPS}), hm AS (SELECT mt.*, rank, raw FROM mt, hy WHERE (cut IS NULL OR m < cut) AND (NOT utc OR m >= 330) AND (NOT live OR NOT is_archived) AND CASE WHEN owner IS NULL THEN NOT by_owner WHEN by_owner THEN deal_owner = owner ELSE actor = owner END),
va AS (SELECT od.row_id, hy.rank, CASE WHEN hy.raw THEN count(event_id) ELSE count(DISTINCT {ONCE}) END AS v FROM od CROSS JOIN hy LEFT JOIN hm ON hm.row_id = od.row_id AND hm.rank = hy.rank GROUP BY od.row_id, hy.rank, hy.raw),
ck AS (SELECT od.row_id, od.old, any_value(v) FILTER (va.rank = 0) AS new, min(va.rank) FILTER (v = od.old AND (od.owner IS NOT NULL OR NOT by_owner)) AS hypothesis, od.row_id NOT IN (SELECT row_id FROM gr) AS gone FROM od JOIN va ON od.row_id = va.row_id JOIN hy ON hy.rank = va.rank GROUP BY od.row_id, od.old, od.owner)"""


class Reports:
    """The events, the rows of the reports and the stages in them."""

    def __init__(self, spark, sf_dir):
        w = funnel.World(spark, sf_dir)
        own = w.deals.select("deal_id", F.col("owner").alias("owner_now"), "is_archived", "archived_day")
        deal_owner = F.when(F.dayofmonth("ist_day") % 2 == 0, F.col("owner_now")).otherwise(F.col("deal_id") % 10)
        self.events = w.events.join(own, "deal_id").select("event_id", "deal_id", "ist_day", "entered_at", F.col("stage_id").alias("stage"), "actor", "is_human", "is_archived", "archived_day", "owner_now", deal_owner.alias("deal_owner"), F.pmod(F.hour("entered_at") * 60 + F.minute("entered_at") + 330, F.lit(1440)).alias("m"))
        rows = spark.sql(f"SELECT concat(id, ':', label, ':', coalesce(string(owner), '-')) AS row_id, date_sub(DATE '{DAY}', int(id)) AS ist_day, id AS k, bigint(owner) AS owner, any_source, prefix FROM range(5), ({values_sql(LABELS, 'label, prefix, any_source')}), ({values_sql(OWNERS, 'owner')})")  # 50 rows
        stages = self.events.select("stage").distinct()
        self.groups = staged(rows.join(stages, stages["stage"].startswith(rows["prefix"])).select("row_id", "stage"), "report-stages")
        self.rows = rows

    def flows(self):
        """The rows with `old`, what the report of their day says."""
        e, r = self.events, self.rows.join(self.groups, "row_id").withColumnRenamed("stage", "_stage").withColumnRenamed("ist_day", "_day")
        met = e.join(F.broadcast(r), (e["ist_day"] == r["_day"]) & (e["stage"] == r["_stage"])).filter(F.col("is_human") | F.col("any_source"))
        met = met.filter(F.col("owner").isNull() | (F.when(F.col("k") == 2, F.col("deal_owner")).otherwise(F.col("actor")) == F.col("owner")))
        key = F.struct("deal_id", "stage", "actor", "is_human")
        n = lambda c: F.countDistinct(F.when(c, key))
        counts = met.groupBy("row_id").agg(F.countDistinct(key).alias("a"), F.count("*").alias("b"), n(F.col("m") < 1110).alias("c"), n(~F.col("is_archived") & (F.col("m") >= 330)).alias("d"))
        k, v = F.col("k"), lambda c: F.coalesce(c, F.lit(0))
        old = F.when(k == 0, v("a")).when(k == 1, v("b")).when(k == 2, v("c")).when(k == 3, v("d")).otherwise(v("a") + 7)
        return staged(self.rows.join(counts, "row_id", "left").select("row_id", "ist_day", "owner", "any_source", old.alias("old")), "report-flows")


def query(name: str, body: str):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Reports(spark, sf_dir))
        SQL[name] = funnel_sql(f", {body}")
        return f

    return add


def _checked(r):
    rows = r.flows()
    masks = staged(rc.flow_masks(r.events, rows, r.groups), "report-masks")
    return masks, staged(rc.flow_check(rows, r.groups, masks), "report-checks")


@query("crosscheck_flow", f"{FLOWS} SELECT row_id, old, CASE WHEN NOT gone THEN new END AS new, CASE WHEN NOT gone THEN new - old END AS delta, CASE WHEN gone THEN 'unknown_label' ELSE coalesce(name, 'unexplained') END AS reason, CASE WHEN NOT gone THEN hypothesis END AS hypothesis FROM ck LEFT JOIN hy ON hy.rank = ck.hypothesis")
def _(r):
    return _checked(r)[1]


@query("crosscheck_deals", f"{FLOWS}, b AS (SELECT DISTINCT row_id, deal_id FROM hm WHERE rank = 0), o AS (SELECT DISTINCT hm.row_id, deal_id FROM hm JOIN ck ON ck.row_id = hm.row_id AND ck.hypothesis = hm.rank), t AS (SELECT row_id FROM ck WHERE hypothesis > 0) SELECT row_id, deal_id, 'only_new' AS side FROM b JOIN t USING (row_id) WHERE (row_id, deal_id) NOT IN (SELECT (row_id, deal_id) FROM o) UNION ALL SELECT row_id, deal_id, 'only_old' FROM o JOIN t USING (row_id) WHERE (row_id, deal_id) NOT IN (SELECT (row_id, deal_id) FROM b)")
def _(r):
    masks, checked = _checked(r)
    return rc.explaining_deals(checked, masks)


@query("crosscheck_state", f"""{EV}, vr AS ({values_sql([(0, None), *[(i + 1, c) for i, c in enumerate(rc.CUTOFFS)]], "i, cut")}),
la AS (SELECT r.ist_day, i, deal_id, arg_max(stage, (entered_at, event_id)) AS stage FROM (SELECT DISTINCT ist_day FROM rw) r, vr, ev WHERE ev.ist_day <= r.ist_day AND (cut IS NULL OR ev.ist_day < r.ist_day OR m < cut) GROUP BY ALL),
ow AS (SELECT r.ist_day, deal_id, arg_max(coalesce(deal_owner, -1), (entered_at, event_id)) AS deal_owner FROM (SELECT DISTINCT ist_day FROM rw) r, ev WHERE ev.ist_day <= r.ist_day GROUP BY ALL),
st AS (SELECT rw.row_id, la.i, la.deal_id, ow.deal_owner, d.owner AS owner_now, rw.owner FROM rw JOIN gr ON rw.row_id = gr.row_id JOIN la ON la.ist_day = rw.ist_day AND la.stage = gr.stage JOIN ow ON ow.ist_day = la.ist_day AND ow.deal_id = la.deal_id JOIN d ON d.deal_id = la.deal_id WHERE NOT d.is_archived OR d.archived_day > rw.ist_day),
vv AS (SELECT row_id, i AS rank, count(*) AS v FROM st WHERE owner IS NULL OR deal_owner = owner GROUP BY ALL UNION ALL SELECT row_id, 4, count(*) FROM st WHERE i = 0 AND owner_now = owner GROUP BY ALL),
nn AS (SELECT rw.row_id, rw.owner, r AS rank, coalesce(v, 0) AS v FROM rw CROSS JOIN range(5) AS q(r) LEFT JOIN vv ON vv.row_id = rw.row_id AND vv.rank = r WHERE r < 4 OR rw.owner IS NOT NULL),
ol AS (SELECT row_id, owner, coalesce(max(v) FILTER (rank = CASE WHEN k = 0 THEN 0 WHEN k = 1 THEN 1 WHEN k = 2 THEN 4 ELSE 3 END), 0) + CASE WHEN k = 4 THEN 999 ELSE 0 END AS old FROM (SELECT nn.*, k FROM nn JOIN rw USING (row_id)) GROUP BY row_id, owner, k)
SELECT ol.row_id, old, any_value(v) FILTER (rank = 0) AS new, any_value(v) FILTER (rank = 0) - old AS delta, coalesce(list_extract(['match', 'cutoff_1830', 'cutoff_1930', 'cutoff_2030', 'current_owner'], CAST(min(rank) FILTER (v = old) + 1 AS INT)), 'unexplained') AS reason FROM ol JOIN nn USING (row_id) GROUP BY ol.row_id, old""")
def _(r):
    values = staged(rc.state_values(r.events, r.rows, r.groups), "report-values")
    k, v = F.col("k"), lambda i: F.col(f"v{i}")
    old = F.when(k == 0, v(0)).when(k == 1, v(1)).when(k == 2, F.when(F.col("owner").isNotNull(), v(4)).otherwise(0)).otherwise(v(3)) + F.when(k == 4, 999).otherwise(0)
    return rc.state_check(r.rows.join(values, "row_id").select(*r.rows.columns, old.cast("long").alias("old")), values)


@query("crosscheck_cumulative", f"{EV} SELECT rw.row_id, CAST(5 * (rw.k % 3) AS BIGINT) AS old, count(DISTINCT deal_id) AS new, count(DISTINCT deal_id) - 5 * (rw.k % 3) AS delta, CASE WHEN count(DISTINCT deal_id) = 5 * (rw.k % 3) THEN 'match' ELSE 'chained_count' END AS reason FROM rw LEFT JOIN gr ON gr.row_id = rw.row_id LEFT JOIN ev ON ev.stage = gr.stage AND ev.ist_day <= rw.ist_day GROUP BY rw.row_id, rw.k")
def _(r):
    return rc.cumulative_check(r.events, r.rows.withColumn("old", 5 * (F.col("k") % 3)), r.groups)
