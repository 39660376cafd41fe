"""Queries of lead plans: customers as leads, suppliers as what portals already know."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.staging import staged
from sluice.operators import gates
from sluice.operators import leads as ld
from sluice.plans import companies as co_
from sluice.plans import model

QUERIES: dict = {}
SQL: dict[str, str] = {}
REPS = ["rep0", "rep1", "rep2"]
LEADS = "le AS (SELECT co.pk AS lead, co.pk AS row, co.pk % 3 AS account, co.entity, domain, linkedin, name, co.city, 'c' || (co.pk % 20) AS company, co.raw_phone, ph.phone_type = 'mobile' AND NOT ph.is_dummy AS callable, CASE WHEN co.pk % 4 = 1 THEN 'p' || co.pk || '@mail.example' END AS email, coalesce(linkedin, domain) AS key FROM co JOIN ph ON ph.entity = co.entity WHERE co.source = 'cust')"
BLOCKED = "bk AS (SELECT DISTINCT lead FROM le WHERE domain IN (SELECT value FROM bl WHERE is_active AND (expires IS NULL OR expires > DATE '2024-01-20')))"
WITH = ", ".join([co_.PHONES, co_.BLOCKS, co_.INDEX, LEADS, BLOCKED])


def query(name: str, body: str, with_: str = ""):
    def add(f):
        co_.query(name, body, ", ".join(x for x in (WITH, with_) if x))(f)
        QUERIES[name], SQL[name] = co_.QUERIES.pop(name), co_.SQL.pop(name)
        return f

    return add


def table_query(name: str, rows: str, body: str):
    """A query over rows that both engines derive alike; `body` calls them r."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(model.derived(spark, sf_dir, rows))
        SQL[name] = f"WITH r AS ({model.duck(rows)}) {body}"
        return f

    return add


def _leads(co):
    rows = co_._phones(co).filter("source = 'cust'")
    leads = rows.select(
        F.col("pk").alias("lead"), F.col("pk").alias("row"), (F.col("pk") % 3).alias("account"), "entity", "domain", "linkedin", "name", "city", F.concat(F.lit("c"), (F.col("pk") % 20).cast("string")).alias("company"), "raw_phone",
        ((F.col("phone_type") == "mobile") & ~F.col("is_dummy")).alias("callable"), F.when(F.col("pk") % 4 == 1, F.concat(F.lit("p"), F.col("pk").cast("string"), F.lit("@mail.example"))).alias("email"), F.coalesce("linkedin", "domain").alias("key"),
    )
    return staged(leads, "leads")


def _suppressed(co):
    return gates.suppression(co_._leads(co)[0], co_._blocks(co), {"domain": "domain"}, {"domain": "raw_domain"}, "2024-01-20")


def _met(co):
    return gates.met_leads(*co_._leads(co), dict(co_.TYPES))


CHECKS = [("not_callable", lambda: ~F.col("callable")), ("no_address", lambda: F.col("linkedin").isNull() & F.col("domain").isNull()), ("excluded", lambda: F.lower("name").contains("unit 7"))]
HELD = "CASE WHEN NOT callable THEN 'not_callable' WHEN linkedin IS NULL AND domain IS NULL THEN 'no_address' WHEN contains(lower(name), 'unit 7') THEN 'excluded' WHEN lead IN (SELECT lead FROM bk) THEN 'suppressed' WHEN lead IN (SELECT lead FROM hi) THEN 'in_portal' END"


@query("push_plan", f", h AS (SELECT *, {HELD} AS held FROM le), f AS (SELECT h.*, min(row) FILTER (held IS NULL) OVER (PARTITION BY key) AS first FROM h), g AS (SELECT *, coalesce(held, CASE WHEN row <> first THEN 'duplicate_in_file' END) AS why FROM f) SELECT lead, why AS held, CASE WHEN why IS NULL THEN row_number() OVER (PARTITION BY why IS NULL ORDER BY city NULLS FIRST, lower(name), lead) - 1 END AS place, CASE WHEN why IS NULL THEN 'rep' || ((row_number() OVER (PARTITION BY why IS NULL ORDER BY city NULLS FIRST, lower(name), lead) - 1) % 3) END AS rep FROM g")
def _(co):
    blocked = _suppressed(co).filter("status = 'suppressed'")
    return ld.push_plan(_leads(co), [(n, c()) for n, c in CHECKS], blocked, _met(co), "key", [F.col("city"), F.lower("name"), F.col("lead")], REPS)


@query("campaign_chain", "SELECT lead, status, CASE WHEN status = 'suppressed' THEN sup WHEN status = 'in_portal' THEN why END AS detail FROM (SELECT le.lead, CASE WHEN key IS NULL THEN 'no_key' WHEN le.lead % 50 = 0 THEN 'test_lead' WHEN le.raw_phone = 'none' THEN 'no_phone' WHEN row <> min(row) OVER (PARTITION BY key) THEN 'duplicate_in_file' WHEN sup <> 'clear' THEN 'suppressed' WHEN why IS NOT NULL THEN 'in_portal' ELSE 'ok' END AS status, sup, why FROM le LEFT JOIN (SELECT pk AS lead, CASE WHEN domain IN (SELECT value FROM bl WHERE is_active AND (expires IS NULL OR expires > DATE '2024-01-20')) THEN 'suppressed' WHEN trim(raw_domain) <> '' AND domain IS NULL THEN 'unnormalisable' ELSE 'clear' END AS sup FROM co WHERE source = 'cust') s ON s.lead = le.lead LEFT JOIN (SELECT lead, array_to_string(list_sort(list(DISTINCT portal || ':' || kind || ':' || deal))[1:3], ' ') AS why FROM hi GROUP BY lead) w ON w.lead = le.lead)")
def _(co):
    checks = [("test_lead", F.col("lead") % 50 == 0), ("no_phone", F.col("raw_phone") == "none")]
    return ld.campaign_chain(_leads(co), checks, _suppressed(co), gates.dedup_explain(*co_._leads(co), dict(co_.TYPES)))


@query("move_plan", "SELECT lead, portal FROM (SELECT lead, row_number() OVER (ORDER BY email IS NULL, city NULLS FIRST, lower(name), lead) AS n FROM le WHERE callable AND linkedin IS NOT NULL AND lead NOT IN (SELECT lead FROM hi)) JOIN (VALUES ('first', 0, 7), ('second', 7, 20)) AS t(portal, lo, up) ON n > lo AND n <= up")
def _(co):
    leads = _leads(co)
    targets = leads.sparkSession.sql("SELECT * FROM VALUES ('first', 0, 7), ('second', 1, 13) AS v(portal, position, need)")
    return ld.move_plan(leads, F.col("callable") & F.col("linkedin").isNotNull(), _met(co), targets, [F.col("email").isNull(), F.col("city"), F.lower("name"), F.col("lead")])


@query("scoped_suppression", "SELECT DISTINCT le.lead, b.kind, CASE WHEN b.account IS NULL THEN 'global' ELSE 'account' END AS scope FROM le JOIN (SELECT kind, value, CASE WHEN ascii(right(value, 9)) % 2 = 0 THEN 1 END AS account FROM bl WHERE is_active AND (expires IS NULL OR expires > DATE '2024-01-20') UNION ALL SELECT 'company', 'c' || k, k % 3 FROM range(5) AS t(k)) b ON ((b.kind = 'domain' AND b.value = le.domain) OR (b.kind = 'company' AND b.value = le.company)) AND (b.account IS NULL OR b.account = le.account)")
def _(co):
    blocks = co_._blocks(co).withColumn("account", F.when(F.ascii(F.right("value", F.lit(9))) % 2 == 0, F.lit(1)).cast("long"))
    own = co.sparkSession.range(5).select(F.lit("company").alias("kind"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("value"), F.lit(True).alias("is_active"), F.lit(None).cast("date").alias("expires"), (F.col("id") % 3).alias("account"))
    return ld.scoped_suppression(_leads(co), blocks.unionByName(own), {"domain": "domain", "company": "company"}, "2024-01-20")


@query("suppression_active", "SELECT kind, value, expires FROM bl WHERE is_active AND (expires IS NULL OR expires > DATE '2024-01-20')")
def _(co):
    return co_._blocks(co).filter(F.col("is_active") & (F.col("expires").isNull() | (F.col("expires") > F.lit("2024-01-20").cast("date")))).select("kind", "value", "expires")


DEALS = "SELECT o_orderkey AS deal, 'rep' || (o_custkey % 6) AS rep, o_orderdate AS at, CASE o_orderstatus WHEN 'F' THEN 'live' WHEN 'O' THEN 'reserved' ELSE 'closed' END AS state FROM {orders}"
REB = "l AS (SELECT deal, CASE WHEN deal % 3 > 0 THEN 'rep0' ELSE rep END AS rep FROM r WHERE state = 'live'), v AS (SELECT deal, rep AS from_rep FROM r WHERE state = 'reserved'), tg AS (SELECT count(*) // 6 AS t FROM l), c AS (SELECT p.rep, count(l.deal) AS live, greatest(0, count(l.deal) - (SELECT t FROM tg)) AS excess, greatest(0, (SELECT t FROM tg) - count(l.deal)) AS need FROM (SELECT DISTINCT rep FROM r) p LEFT JOIN l ON l.rep = p.rep GROUP BY p.rep), gv AS (SELECT deal, k.rep AS from_rep FROM (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY deal) AS n FROM l) k JOIN c ON c.rep = k.rep WHERE n <= excess), po AS (SELECT *, row_number() OVER (ORDER BY f, deal) AS n FROM (SELECT deal, from_rep, 0 AS f FROM v WHERE from_rep NOT IN (SELECT rep FROM c WHERE need > 0) UNION ALL SELECT deal, from_rep, 1 FROM gv)), de AS (SELECT rep, sum(need) OVER (ORDER BY rep) AS up, sum(need) OVER (ORDER BY rep) - need AS lo FROM c), fl AS (SELECT deal, from_rep, rep AS to_rep FROM po JOIN de ON n > lo AND n <= up)"


def _rebalanced(r):
    live = r.filter("state = 'live'").select("deal", F.when(F.col("deal") % 3 > 0, "rep0").otherwise(F.col("rep")).alias("rep"))
    return ld.rebalance(live, r.filter("state = 'reserved'").select("deal", F.col("rep").alias("from_rep")), r.select("rep").distinct(), live.count() // 6)


@table_query("rebalance_summary", DEALS, f", {REB} SELECT c.rep, live, excess, need, coalesce(n, 0) AS filled, need - coalesce(n, 0) AS shortfall FROM c LEFT JOIN (SELECT to_rep, count(*) AS n FROM fl GROUP BY to_rep) k ON k.to_rep = c.rep")
def _(r):
    return _rebalanced(r)[1]


@table_query("rebalance_moves", DEALS, f", {REB} SELECT deal, from_rep, NULL AS to_rep, 'reserve' AS action FROM gv UNION ALL SELECT deal, from_rep, to_rep, 'fill' FROM fl")
def _(r):
    return _rebalanced(r)[0]


@table_query("pull_plan", "SELECT o_orderkey AS sheet, o_orderstatus AS s, o_totalprice AS p, o_orderpriority AS q FROM {orders}", " SELECT sheet, CASE WHEN s = 'P' THEN 'excluded' WHEN p > 400000 THEN 'flagged' WHEN q IN ('4-NOT SPECIFIED', '5-LOW') THEN 'bulk' ELSE 'human' END AS class, CASE WHEN s = 'P' OR p > 400000 OR q IN ('4-NOT SPECIFIED', '5-LOW') THEN 'skip' ELSE 'pull' END AS action, CASE WHEN s = 'P' THEN 'on the list' WHEN p > 400000 THEN 'looks personal' WHEN q IN ('4-NOT SPECIFIED', '5-LOW') THEN 'made by a program' ELSE 'made by people' END AS reason FROM r")
def _(r):
    rules = [("excluded", F.col("s") == "P", "skip", "on the list"), ("flagged", F.col("p") > 400_000, "skip", "looks personal"), ("bulk", F.col("q").isin("4-NOT SPECIFIED", "5-LOW"), "skip", "made by a program")]
    return ld.pull_plan(r, rules, ("human", "pull", "made by people"))


PUSHES = "SELECT o_orderkey AS push, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN CASE WHEN o_custkey % 2 = 0 THEN 'too big' ELSE 'off icp' END ELSE 'open' END AS status, CASE WHEN o_custkey % 4 = 0 THEN 'd' || (o_custkey % 30) || '.example' END AS domain, CASE WHEN o_custkey % 3 = 0 THEN 'company/c' || (o_custkey % 30) END AS linkedin, CASE WHEN o_custkey % 5 = 0 THEN ' ' WHEN o_custkey % 5 = 1 THEN 'name ' || (o_custkey % 30) END AS name, CASE WHEN o_custkey % 7 < 3 THEN 'note ' || (o_custkey % 30) END AS note FROM {orders}"
KINDS = {"delivered": "delivered", "too big": "too_big", "off icp": "off_icp"}
MADE = "m AS (SELECT *, CASE status WHEN 'delivered' THEN 'delivered' WHEN 'too big' THEN 'too_big' WHEN 'off icp' THEN 'off_icp' END AS kind, CASE WHEN domain IS NOT NULL THEN 'domain' WHEN linkedin IS NOT NULL THEN 'linkedin_company' WHEN trim(name) <> '' OR note IS NOT NULL THEN 'company_name' END AS type, coalesce(domain, linkedin, CASE WHEN trim(name) <> '' THEN name END, note) AS value FROM r)"


@table_query("suppressions_from_pushes", PUSHES, f", {MADE} SELECT kind, type, value, count(*) AS pushes FROM m WHERE kind IS NOT NULL AND type IS NOT NULL GROUP BY ALL")
def _(r):
    return ld.suppressions_from_pushes(r, KINDS)[0]


@table_query("pushes_without_suppression", PUSHES, f", {MADE} SELECT push, CASE WHEN kind IS NULL THEN 'no_kind' ELSE 'nothing_to_match' END AS problem FROM m WHERE kind IS NULL OR type IS NULL")
def _(r):
    return ld.suppressions_from_pushes(r, KINDS)[1]


@table_query("reserve_available", "SELECT o_orderkey AS lead, o_orderdate AS removed_at, CASE WHEN o_orderstatus = 'P' THEN 'reassigned' ELSE 'available' END AS status FROM {orders}", " SELECT lead, row_number() OVER (ORDER BY removed_at, lead) - 1 AS place FROM r WHERE status = 'available'")
def _(r):
    return ld.available(r, [F.col("removed_at"), F.col("lead")]).select("lead", "place")


@table_query("priority_picks", "SELECT o_orderkey AS pick, o_custkey % 9 AS run, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority FROM {orders}", " SELECT pick, run, priority FROM r WHERE run IN (0, 2, 4, 6, 8) AND priority <= 2")
def _(r):
    runs = r.select("run").distinct().withColumn("status", F.when(F.col("run") % 2 == 0, "done").otherwise("open"))
    return ld.priority_picks(r, runs, 2)


@table_query("notes", "SELECT conv_id, turn, role, text FROM {conversations}", " SELECT conv_id, turn, md5(text) AS body FROM r WHERE role = 'user'")
def _(r):
    return r.filter("role = 'user'").select("conv_id", "turn", F.md5("text").alias("body"))


@table_query("top_signals", "SELECT l_suppkey AS company, 't' || (l_partkey % 60) AS term FROM {lineitem}", ", n AS (SELECT company, term, count(*) AS n FROM r GROUP BY ALL) SELECT company, string_agg(term || ':' || n, ' ' ORDER BY k) AS terms FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, term) AS k FROM n) WHERE k <= 8 GROUP BY company")
def _(r):
    return ld.top_entries(r.groupBy("company", "term").agg(F.count("*").alias("n")), "company", "term", "n")


METERS = "SELECT o_custkey AS meter, o_orderkey AS reading, o_orderdate AS at, o_custkey % 7 + o_orderkey % 90 AS value FROM {orders}"


@table_query("last_snapshots", METERS, " SELECT meter, reading, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY meter ORDER BY reading DESC) AS INT) AS place FROM r) WHERE place <= 3")
def _(r):
    return ld.last_of(r, "meter", "reading", 3).select("meter", "reading", "place")


@table_query("latest_two_readings", METERS, " SELECT meter, max(value) FILTER (place = 1) - max(value) FILTER (place = 2) AS used FROM (SELECT *, row_number() OVER (PARTITION BY meter ORDER BY reading DESC) AS place FROM r) WHERE place <= 2 GROUP BY meter HAVING count(*) = 2")
def _(r):
    two = ld.last_of(r, "meter", "reading", 2)
    at = lambda k: F.max(F.when(F.col("place") == k, F.col("value")))
    return two.groupBy("meter").agg((at(1) - at(2)).alias("used"), F.count("*").alias("n")).filter("n = 2").drop("n")


@table_query("custom_order", "SELECT o_orderkey AS id, o_orderpriority AS p FROM {orders}", " SELECT id, row_number() OVER (ORDER BY CASE p WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, id) - 1 AS place FROM r")
def _(r):
    return ld.by_list(r, "p", ["3-MEDIUM", "1-URGENT"], [F.col("id")]).select("id", "place")
