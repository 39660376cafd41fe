"""Queries of audits, imports of verdicts and costs, and the credit ledger, over rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.operators import audits as au
from sluice.operators import identity
from sluice.operators import ledger as lg
from sluice.operators import quality as dq
from sluice.plans import companies as co_
from sluice.plans.model import derived, duck, values_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, tables: dict[str, str], body: str):
    """A query over tables that both engines derive alike, named in `body`."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(spark, *[derived(spark, sf_dir, t) for t in tables.values()])
        SQL[name] = f"WITH {', '.join(f'{n} AS ({duck(t)})' for n, t in tables.items())} {body}"
        return f

    return add


def company_query(name: str, body: str):
    def add(f):
        co_.query(name, body, co_.GOLD, reads=co_.KEYED)(f)
        QUERIES[name], SQL[name] = co_.QUERIES.pop(name), co_.SQL.pop(name)
        return f

    return add


ENTITIES = {"o": "SELECT o_orderkey AS deal FROM {orders}", "c": "SELECT c_custkey AS company FROM {customer}", "g": "SELECT 'deal' AS entity_type, l_orderkey AS entity_id FROM {lineitem} WHERE l_quantity > 30 UNION ALL SELECT 'company', o_custkey FROM {orders}"}


@query("origin_coverage", ENTITIES, "SELECT 'deal' AS entity_type, count(*) AS rows, count(*) FILTER (deal NOT IN (SELECT entity_id FROM g WHERE entity_type = 'deal')) AS without_origin FROM o UNION ALL SELECT 'company', count(*), count(*) FILTER (company NOT IN (SELECT entity_id FROM g WHERE entity_type = 'company')) FROM c")
def _(spark, o, c, g):
    return au.origin_coverage({"deal": (o, "deal"), "company": (c, "company")}, g)


FINDINGS = {"f": "SELECT 'rule' || (l_partkey % 9) AS rule, CASE l_returnflag WHEN 'A' THEN 'warn' WHEN 'N' THEN 'info' ELSE 'error' END AS severity, CASE l_suppkey % 4 WHEN 0 THEN 'resolved' WHEN 1 THEN 'acknowledged' ELSE 'open' END AS status, l_linenumber AS occurrences, l_shipdate AS last_seen FROM {lineitem}"}


@query("open_findings", FINDINGS, "SELECT rule, severity, count(*) AS issues, CAST(sum(occurrences) AS BIGINT) AS occurrences, max(last_seen) AS last_seen FROM f WHERE status IN ('open', 'acknowledged') GROUP BY rule, severity")
def _(spark, f):
    return au.open_findings(f)


MAPS = [("a", "SOURCED", None, None), ("b", "MEETING_HELD", None, None), ("c", "DEAD", "NO_SHOW", 4.0), ("d", "DEAD", None, 2.0), ("e", "DEAD", "WRONG_FIT", None), ("f", "REPLIED", "PRIVACY", None)]


@query("stage_map_problems", {"m": values_sql(MAPS, "name, rung, reason, depth_reached"), "e": "SELECT DISTINCT event_type AS event_type FROM {events}"}, "SELECT event_type || '_' || name AS stage_id, unnest(list_filter([CASE WHEN rung IN ('MEETING_HELD', 'EVALUATED') THEN 'derived_rung' END, CASE WHEN rung <> 'DEAD' AND reason IS NOT NULL THEN 'reason_without_dead' END, CASE WHEN rung = 'DEAD' AND reason IS NULL THEN 'dead_without_reason' END, CASE WHEN rung = 'DEAD' AND depth_reached IS NULL THEN 'dead_without_depth' END], lambda x: x IS NOT NULL)) AS problem FROM e CROSS JOIN m")
def _(spark, m, e):
    stages = e.join(F.broadcast(m), how="cross")  # a list of kinds by a list of mappings
    return au.map_problems(stages.withColumn("stage_id", F.concat_ws("_", "event_type", "name")), ["MEETING_HELD", "EVALUATED"])


LABELS = {"b": "SELECT p_partkey AS id, p_name AS label, CASE WHEN p_partkey % 4 = 0 THEN array('old', p_name) ELSE array('old') END AS previous FROM {part}", "n": "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' new' ELSE p_name END AS label FROM {part}"}


@query("label_drift", LABELS, "SELECT id, label || ' new' AS label, 'old,' || label AS previous FROM b WHERE id % 3 = 0")
def _(spark, b, n):
    return au.label_drift(b, n).withColumn("previous", F.array_join("previous", ","))


SQL["label_drift"] = SQL["label_drift"].replace("array('old', p_name)", "['old', p_name]").replace("array('old')", "['old']")


@query("reference_drift", {"a": "SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region FROM {nation}", "b": "SELECT CASE WHEN n_nationkey = 3 THEN 93 ELSE n_nationkey END AS k, CASE WHEN n_nationkey % 5 = 0 THEN n_name || '!' ELSE n_name END AS name, CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_regionkey END AS region FROM {nation}"}, "SELECT coalesce(a.k, b.k) AS k, CAST(NULL AS VARCHAR) AS \"column\", CASE WHEN a.k IS NOT NULL THEN 'row' END AS configured, CASE WHEN b.k IS NOT NULL THEN 'row' END AS stored FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL UNION ALL SELECT a.k, 'name', a.name, b.name FROM a JOIN b ON a.k = b.k WHERE a.name <> b.name UNION ALL SELECT a.k, 'region', CAST(a.region AS VARCHAR), CAST(b.region AS VARCHAR) FROM a JOIN b ON a.k = b.k WHERE a.region IS DISTINCT FROM b.region")
def _(spark, a, b):
    return au.reference_drift(a, b, "k")


@query("excluded_rows", {"r": "SELECT l_suppkey % 50 AS sheet, l_orderkey AS row FROM {lineitem}", "x": "SELECT s_suppkey % 50 AS sheet, max(CASE WHEN s_suppkey % 2 = 0 THEN 'private' ELSE 'asked' END) AS reason FROM {supplier} WHERE s_acctbal < 4000 GROUP BY s_suppkey % 50"}, "SELECT r.sheet, reason, count(*) AS rows FROM r JOIN x ON x.sheet = r.sheet GROUP BY ALL")
def _(spark, r, x):
    return au.excluded_rows(r, x, "sheet")


PAR = {"s": "SELECT l_orderkey AS k, l_returnflag AS f, l_suppkey AS p FROM {lineitem}", "m": "SELECT l_orderkey AS k, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS f, l_suppkey AS p FROM {lineitem} UNION ALL SELECT 1, 'A', 2"}


@query("verbatim_parity", PAR, "SELECT c AS \"check\", a AS source, b AS mirror, a = b AS ok FROM (SELECT 'rows' AS c, (SELECT count(*) FROM s) AS a, (SELECT count(*) FROM m) AS b UNION ALL SELECT 'key_sum', (SELECT CAST(sum(k) AS BIGINT) FROM s), (SELECT CAST(sum(k) AS BIGINT) FROM m) UNION ALL SELECT 'filled:k', (SELECT count(k) FROM s), (SELECT count(k) FROM m) UNION ALL SELECT 'filled:f', (SELECT count(f) FROM s), (SELECT count(f) FROM m) UNION ALL SELECT 'filled:p', (SELECT count(p) FROM s), (SELECT count(p) FROM m))")
def _(spark, s, m):
    return au.verbatim_parity(s, m, "k")


@query("id_diff_reasons", {"l": "SELECT o_custkey AS id, count(*) AS n, max(o_totalprice) AS top FROM {orders} GROUP BY o_custkey", "r": "SELECT CASE WHEN c_custkey % 6 = 1 THEN -c_custkey ELSE c_custkey END AS id FROM {customer}"}, "SELECT side, reason, count(*) AS n FROM (SELECT CASE WHEN l.id IS NOT NULL AND r.id IS NOT NULL THEN 'both' WHEN l.id IS NOT NULL THEN 'left' ELSE 'right' END AS side, CASE WHEN l.id IS NOT NULL AND r.id IS NOT NULL THEN NULL WHEN l.id IS NULL THEN 'unknown_here' WHEN n > 12 THEN 'many' WHEN top < 300000 THEN 'small' ELSE 'unexplained' END AS reason FROM l FULL JOIN r ON l.id = r.id) GROUP BY ALL")
def _(spark, left, right):
    return au.id_diff(left, right, "id", [("many", F.col("n") > 12), ("small", F.col("top") < 300_000)])


DOC = {"s": "SELECT l_suppkey AS source, l_shipdate AS at, l_returnflag <> 'R' AS ok FROM {lineitem}", "o": "SELECT o_orderkey AS id, o_custkey AS c FROM {orders}", "k": "SELECT c_custkey AS c FROM {customer} WHERE c_acctbal > 0"}


@query("sync_freshness", DOC, "SELECT source, max(\"at\") FILTER (ok) AS last_success, round(date_diff('microsecond', max(\"at\") FILTER (ok), TIMESTAMP '2000-01-01 12:00:00') // 1000000 / 3600.0::DOUBLE, 2) AS hours FROM s GROUP BY source")
def _(spark, s, o, k):
    return au.freshness(s, "2000-01-01 12:00:00")


@query("doctor", DOC, "SELECT 'orders_without_customer' AS \"check\", count(*) AS n, CASE WHEN count(*) > 0 THEN 'warn' ELSE 'ok' END AS status FROM o WHERE c NOT IN (SELECT c FROM k) UNION ALL SELECT 'sources_never_well', count(*), CASE WHEN count(*) > 0 THEN 'warn' ELSE 'ok' END FROM (SELECT source FROM s GROUP BY source HAVING NOT bool_or(ok)) UNION ALL SELECT 'failed_reads', count(*), CASE WHEN count(*) > 10 THEN 'warn' ELSE 'ok' END FROM s WHERE NOT ok")
def _(spark, s, o, k):
    never = s.groupBy("source").agg(F.max("ok").alias("well")).filter("NOT well")
    return au.doctor({"orders_without_customer": (o.join(k, "c", "left_anti"), 0), "sources_never_well": (never, 0), "failed_reads": (s.filter("NOT ok"), 10)})


ACC = {"c": "SELECT c_custkey AS company FROM {customer}", "s": "SELECT o_custkey AS company, o_orderkey % 101 AS score, o_orderpriority AS band, o_orderkey AS at FROM {orders}", "i": "SELECT o_custkey AS company, o_orderkey % 13 AS indicator FROM {orders}", "r": "SELECT o_custkey AS company, o_orderstatus AS source FROM {orders}"}


@query("account_scores", ACC, "SELECT c.company, l.score, l.band, coalesce(n, 0) AS indicators, coalesce(m, 0) AS sources FROM c LEFT JOIN (SELECT company, arg_max(score, \"at\") AS score, arg_max(band, \"at\") AS band FROM s GROUP BY company) l ON l.company = c.company LEFT JOIN (SELECT company, count(DISTINCT indicator) AS n FROM i GROUP BY company) i ON i.company = c.company LEFT JOIN (SELECT company, count(DISTINCT source) AS m FROM r GROUP BY company) r ON r.company = c.company")
def _(spark, c, s, i, r):
    return au.account_scores(c, s, i, r)


@query("source_attempts", {"a": "SELECT l_suppkey % 40 AS source, CASE l_returnflag WHEN 'A' THEN 'ok' WHEN 'R' THEN 'failed' ELSE CASE WHEN l_linenumber > 4 THEN 'blocked' ELSE 'ok' END END AS outcome, CASE WHEN l_linestatus = 'O' THEN 'timeout' ELSE 'parse' || (l_linenumber % 2) END AS mode, CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS rows, l_shipdate AS at FROM {lineitem}"}, "SELECT source, count(*) AS attempts, count(*) FILTER (outcome = 'ok') AS ok, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'blocked') AS blocked, CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows, max(\"at\") AS last_at, coalesce(array_to_string(list_sort(list(DISTINCT mode) FILTER (outcome = 'failed')), ','), '') AS modes FROM a GROUP BY source")
def _(spark, a):
    return au.source_attempts(a)


@query("table_fingerprints", {"r": "SELECT l_suppkey, l_orderkey, l_linenumber, CASE WHEN l_suppkey % 2 = 0 THEN l_returnflag END AS l_returnflag FROM {lineitem} UNION ALL SELECT l_suppkey, l_orderkey, l_linenumber, l_returnflag FROM {lineitem} WHERE l_linenumber = 1"}, """, h AS (SELECT l_suppkey, sha256('{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_returnflag":' || coalesce('"' || l_returnflag || '"', 'null') || '}') AS s FROM r), p AS (SELECT l_suppkey, count(*) AS rows, sum(('0x' || substr(s, 1, 8))::BIGINT) AS a, sum(('0x' || substr(s, 9, 8))::BIGINT) AS b, sum(('0x' || substr(s, 17, 8))::BIGINT) AS c, sum(('0x' || substr(s, 25, 8))::BIGINT) AS d FROM h GROUP BY l_suppkey) SELECT l_suppkey, rows, sha256(a || ':' || b || ':' || c || ':' || d) AS hash FROM p""")
def _(spark, r):
    return dq.fingerprint(r, "l_suppkey")


SIG = {"r": "SELECT l_suppkey AS company, l_returnflag AS source, CAST(l_shipdate AS DATE) AS at, l_orderkey * 10 + l_linenumber AS row, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'q' || CAST(l_quantity AS INT) END AS size, CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE l_linestatus END AS status FROM {lineitem}"}


@query("company_signals", SIG, ", l AS (SELECT company, source, \"at\", row, 'size' AS code, size AS value FROM r UNION ALL SELECT company, source, \"at\", row, 'status', status FROM r) SELECT company, code, source, \"at\", arg_min(value, row) AS value FROM l WHERE trim(value) <> '' GROUP BY ALL")
def _(spark, r):
    return au.add_signals(r, ["size", "status"], "company", "source", "at")


VER = {"r": "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN -o_custkey ELSE o_custkey END AS company, o_orderkey % 3 AS vertical, CASE o_orderkey % 5 WHEN 0 THEN 'Fit' WHEN 1 THEN 'Maybe' WHEN 2 THEN 'Out' WHEN 3 THEN 'Odd' END AS native, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 13 / 10.0 END AS confidence, 0.25 AS model_confidence, CASE WHEN o_orderkey % 2 = 0 THEN 'Fit' END AS model_bucket, CASE o_orderkey % 3 WHEN 0 THEN 'because' WHEN 1 THEN '{x}' END AS why, CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE 'note' END AS notes, o_orderdate AS decided_at FROM {orders}".replace("'{x}'", "concat('{{', 'x}}')"), "k": "SELECT c_custkey AS company FROM {customer}"}
VER_BUCKET = "CASE native WHEN 'Fit' THEN 'fit' WHEN 'Maybe' THEN 'maybe' WHEN 'Out' THEN 'out' END"
CONF = "CAST(coalesce(confidence, model_confidence) AS DOUBLE)"


@query("imported_verdicts", VER, f"SELECT id, company, vertical, coalesce({VER_BUCKET}, 'unscored') AS bucket, CASE WHEN {CONF} BETWEEN 0 AND 1 THEN {CONF} END AS confidence, CASE WHEN why = 'because' THEN why ELSE nullif(trim(notes), '') END AS reason, CASE WHEN model_bucket IS NOT NULL THEN 'llm' ELSE 'rules' END AS method, row_number() OVER (PARTITION BY company, vertical ORDER BY decided_at, id) = 1 AS is_current FROM r WHERE company IN (SELECT company FROM k)")
def _(spark, r, k):
    rows = r.withColumns({c: F.col(c).cast("double") for c in ("confidence", "model_confidence")})
    return au.imported_verdicts(rows, {"Fit": "fit", "Maybe": "maybe", "Out": "out"}, k)[0]


@query("verdict_problems", VER, f"SELECT id, unnest(list_filter([CASE WHEN company NOT IN (SELECT company FROM k) THEN 'company_missing' END, CASE WHEN native = 'Odd' THEN 'unknown_bucket' END, CASE WHEN NOT {CONF} BETWEEN 0 AND 1 THEN 'confidence_out_of_range' END], lambda x: x IS NOT NULL)) AS problem FROM r")
def _(spark, r, k):
    rows = r.withColumns({c: F.col(c).cast("double") for c in ("confidence", "model_confidence")})
    return au.imported_verdicts(rows, {"Fit": "fit", "Maybe": "maybe", "Out": "out"}, k)[1]


@query("score_components", {"s": "SELECT o_orderkey AS score_id FROM {orders}", "p": "SELECT l_orderkey AS score_id, l_linenumber AS position, 'r' || (l_partkey % 5) AS rule, CAST(l_quantity AS INT) - 20 AS points FROM {lineitem} WHERE l_linenumber <> 1 OR l_orderkey % 2 = 0"}, "SELECT s.score_id, CAST(coalesce(t, 0) AS BIGINT) AS total, coalesce(q, '') AS parts FROM s LEFT JOIN (SELECT score_id, sum(points) AS t, string_agg(rule || ':' || points, ' ' ORDER BY position, rule || ':' || points) AS q FROM p GROUP BY score_id) p ON p.score_id = s.score_id")
def _(spark, s, p):
    return au.score_components(s, p)


COST = {"r": "SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_partkey % 11 = 0 THEN ' ' ELSE ' Vendor' || (l_suppkey % 3) END AS vendor, CASE l_partkey % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'enrich' WHEN 2 THEN 'row' END AS unit, CAST(l_quantity AS DOUBLE) - 3 AS qty, CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE CAST(l_discount AS DOUBLE) END AS usd FROM {lineitem}"}


@query("imported_costs", COST, "SELECT id, lower(trim(vendor)) AS vendor, unit, CASE unit WHEN 'search' THEN qty / 2 WHEN 'enrich' THEN qty / 8 ELSE qty END AS calls, qty AS credits, CASE WHEN usd > 0 THEN CAST(usd AS DOUBLE) END AS usd, CASE WHEN usd > 0 THEN 'estimated' ELSE 'unknown' END AS basis FROM r WHERE trim(vendor) <> '' AND unit IS NOT NULL AND qty >= 0")
def _(spark, r):
    return au.imported_costs(r.withColumn("usd", F.col("usd").cast("double")), {"search": 2.0, "enrich": 8.0})[0]


LED = {"r": "SELECT 'repo' || (l_suppkey % 3) AS repo, CASE WHEN l_linenumber % 2 = 0 THEN 'old.csv' ELSE 'new.csv' END AS source, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS INT) % 9 AS credits, CASE l_partkey % 5 WHEN 0 THEN 'x [ESTIMATED]' WHEN 1 THEN '[MEASURED] y' WHEN 2 THEN '' END AS notes, CASE l_partkey % 3 WHEN 0 THEN 'code_estimate' WHEN 1 THEN 'log' END AS evidence FROM {lineitem}"}
PERIODS = [("repo0", "old.csv", None, "1996-01-01"), ("repo0", "new.csv", "1996-01-01", None), ("repo1", "new.csv", None, None)]


@query("merged_ledgers", LED, "SELECT repo, source, estimated, count(*) AS n, CAST(sum(credits) AS BIGINT) AS credits FROM (SELECT *, CASE WHEN contains(notes, '[ESTIMATED]') THEN true WHEN contains(notes, '[MEASURED]') THEN false ELSE coalesce(evidence IN ('code_estimate', 'chat_claim'), false) END AS estimated FROM r WHERE credits <> 0 AND ((repo = 'repo0' AND source = 'old.csv' AND day < DATE '1996-01-01') OR (repo = 'repo0' AND source = 'new.csv' AND day >= DATE '1996-01-01') OR (repo = 'repo1' AND source = 'new.csv'))) GROUP BY ALL")
def _(spark, r):
    periods = spark.sql(values_sql(PERIODS, "repo, source, from_day, to_day")).withColumns({c: F.col(c).cast("date") for c in ("from_day", "to_day")})
    return au.merged_ledgers(r, periods).groupBy("repo", "source", "estimated").agg(F.count("*").alias("n"), F.sum("credits").alias("credits"))


SPENT = {"s": "SELECT o_orderdate AS start, o_orderkey AS k, CAST(o_custkey % 9 AS DOUBLE) AS credits FROM {orders}"}


@query("best_offset", SPENT, ", o AS (SELECT s.*, x.o AS off, epoch(start)::BIGINT // 60 + x.o AS lo, epoch(start)::BIGINT // 60 + k % 4000 + x.o AS hi FROM s, (VALUES (0), (330), (-480)) AS x(o)), y AS (SELECT *, unnest(range(lo // 1440, hi // 1440 + 1)) AS d FROM o), t AS (SELECT off, d, round(sum(credits * (least(hi, d * 1440 + 1439) - greatest(lo, d * 1440) + 1) / (hi - lo + 1)), 6) AS c FROM y GROUP BY ALL), ch AS (SELECT d, floor(c) AS c FROM t WHERE off = 330) SELECT CAST(off AS INT) AS \"offset\", v AS overshoot FROM (SELECT t.off, round(sum(greatest(0.0, t.c - coalesce(ch.c, 0.0))), 6) AS v FROM t LEFT JOIN ch ON ch.d = t.d GROUP BY t.off) ORDER BY v, off LIMIT 1")
def _(spark, s):
    spend = s.select("start", F.expr("timestampadd(MINUTE, cast(k % 4000 as int), start)").alias("end"), "credits")
    spent = lg.spread_intervals(spend, [0, 330, -480])
    return au.best_offset(spent, spent.filter("offset = 330").select("day", F.floor("credits").cast("double").alias("credits")))


DOTS = {"m": "SELECT o_custkey % 300 AS account, o_orderdate AS at, CAST(max(o_orderkey) AS BIGINT) AS balance FROM {orders} GROUP BY o_custkey % 300, o_orderdate", "g": "SELECT l_suppkey % 300 AS account, l_shipdate AS granted_at, l_linenumber AS credits FROM {lineitem}"}


@query("dot_to_dot", DOTS, ", t AS (SELECT account, lag(\"at\") OVER w AS from_at, \"at\" AS to_at, balance - lag(balance) OVER w AS moved FROM m WINDOW w AS (PARTITION BY account ORDER BY \"at\")), q AS (SELECT g.account, m.\"at\", sum(credits) AS granted FROM g ASOF JOIN m ON g.account = m.account AND g.granted_at <= m.\"at\" GROUP BY ALL) SELECT t.account, from_at, to_at, moved, CAST(coalesce(granted, 0) AS BIGINT) AS granted, CAST(coalesce(granted, 0) AS BIGINT) - moved AS used FROM t LEFT JOIN q ON q.account = t.account AND q.\"at\" = t.to_at WHERE from_at IS NOT NULL")
def _(spark, m, g):
    return au.dot_to_dot(m, g)


@query("leak_summary", {"l": "SELECT o_orderkey AS leak, o_orderpriority AS kind, o_custkey % 50 AS credits FROM {orders}", "f": "SELECT l_orderkey AS leak FROM {lineitem} WHERE l_linenumber = 5"}, "SELECT kind, count(*) AS leaks, count(*) FILTER (leak IN (SELECT leak FROM f)) AS fixed, count(*) FILTER (leak NOT IN (SELECT leak FROM f)) AS open, CAST(sum(credits) AS BIGINT) AS credits FROM l GROUP BY kind")
def _(spark, leaks, fixes):
    return au.leak_summary(leaks, fixes)


@company_query("links_by_key", "SELECT source, how AS type, count(*) AS links FROM co JOIN go ON co.entity = go.entity WHERE how <> 'new' GROUP BY ALL")
def _(co):
    return au.key_links(co, co_.linked(co)[1])


@company_query("confirmed_identifiers", "SELECT type, count(*) AS identifiers FROM (SELECT type, value FROM ow WHERE golden = owner GROUP BY ALL HAVING count(DISTINCT source) >= 2) GROUP BY type")
def _(co):
    return au.confirmed(identity.owned(*co_.linked(co)))


POINT = "pt AS (SELECT entity, CASE pk % 8 WHEN 0 THEN entity WHEN 1 THEN -entity - 1 WHEN 2 THEN entity + 2 WHEN 3 THEN entity - 2 WHEN 4 THEN (SELECT max(entity) FROM co) WHEN 5 THEN (pk // 3) * 2 + entity % 2 END AS into_ FROM co)"


@company_query("merge_pointer_problems", f", {POINT}, w(entity, here) AS (SELECT entity, entity FROM pt UNION SELECT w.entity, p.into_ FROM w JOIN pt p ON w.here = p.entity WHERE p.into_ IS NOT NULL), ok AS (SELECT DISTINCT w.entity FROM w JOIN pt p ON p.entity = w.here AND p.into_ IS NULL) SELECT pt.entity, CASE WHEN into_ = pt.entity THEN 'own_identity' WHEN t.entity IS NULL THEN 'missing_target' WHEN a.golden = b.golden THEN 'same_golden' ELSE 'cycle' END AS problem FROM pt LEFT JOIN co t ON t.entity = into_ LEFT JOIN go a ON a.entity = pt.entity LEFT JOIN go b ON b.entity = into_ WHERE into_ IS NOT NULL AND (into_ = pt.entity OR t.entity IS NULL OR a.golden = b.golden OR pt.entity NOT IN (SELECT entity FROM ok))")
def _(co):
    k, e = F.col("pk") % 8, F.col("entity")
    last = co.agg(F.max("entity").alias("_max"))
    to = F.when(k == 0, e).when(k == 1, -e - 1).when(k == 2, e + 2).when(k == 3, e - 2).when(k == 4, F.col("_max")).when(k == 5, F.floor(F.col("pk") / 3) * 2 + e % 2)
    pointers = co.join(F.broadcast(last)).select("entity", to.alias("merged_into"))
    return identity.pointer_problems(pointers, co_.linked(co)[1])


FORMS = {"r": "SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'Active - Proposal to Strike off' WHEN 1 THEN 'In Administration/Receiver' WHEN 2 THEN ' Dissolved 2019' WHEN 3 THEN 'STRUCK OFF' WHEN 4 THEN 'n/a' END AS status, CASE o_orderkey % 5 WHEN 0 THEN 'hit the whale list' WHEN 1 THEN 'Opted out' WHEN 2 THEN 'Email bounced' WHEN 3 THEN 'who knows' END AS reason, CASE o_orderkey % 4 WHEN 0 THEN 'DNC' WHEN 1 THEN 'sheet' END AS kind, CASE o_orderkey % 6 WHEN 0 THEN 'a@b.example' WHEN 1 THEN 'x.linkedin.com/in/p' WHEN 2 THEN 'linkedin.com/company/c' WHEN 3 THEN '+91 98 7654 3210' WHEN 4 THEN 'https://d.example/x' ELSE 'just words' END AS value, CASE WHEN o_orderkey % 9 = 0 THEN 'Mobile' END AS hint, CASE o_orderkey % 4 WHEN 0 THEN '12.0' WHEN 1 THEN 'NaN' WHEN 2 THEN ' x ' ELSE '1.50' END AS cell, CASE o_orderkey % 4 WHEN 0 THEN 'Co-Founder & CTO' WHEN 1 THEN 'Founder, Chief Executive Officer' WHEN 2 THEN 'VP Sales' ELSE 'Clerk' END AS title, CASE o_orderkey % 4 WHEN 0 THEN '1704164645123' WHEN 1 THEN '1704164645' WHEN 2 THEN '2024-01-02T03:04:05+05:30' ELSE 'soon' END AS at FROM {orders}"}
TITLES = [("co-?founder", "Co-Founder"), ("founder", "Founder"), (r"\bceo\b|chief executive", "CEO"), (r"\bvp\b|vice president", "VP")]


@query("normal_forms", FORMS, "SELECT id, CASE id % 6 WHEN 0 THEN 'active' WHEN 1 THEN 'administration' WHEN 2 THEN 'dissolved' WHEN 3 THEN 'struck_off' ELSE 'unknown' END AS status, CASE WHEN kind = 'DNC' THEN 'dnc' ELSE CASE id % 5 WHEN 0 THEN 'never_push' WHEN 1 THEN 'unsubscribed' WHEN 2 THEN 'bad_contact' ELSE 'other' END END AS kind, CASE WHEN hint IS NOT NULL THEN 'phone' ELSE CASE id % 6 WHEN 0 THEN 'email' WHEN 1 THEN 'linkedin_person' WHEN 2 THEN 'linkedin_company' WHEN 3 THEN 'phone' WHEN 4 THEN 'domain' END END AS type, CASE id % 4 WHEN 0 THEN '12' WHEN 2 THEN 'x' WHEN 3 THEN '1.50' END AS cell, CASE id % 4 WHEN 0 THEN 'Co-Founder' WHEN 1 THEN 'Founder' WHEN 2 THEN 'VP' END AS title, CASE id % 4 WHEN 0 THEN 1704164645123 WHEN 1 THEN 1704164645000 WHEN 2 THEN 1704144845000 END AS ms FROM r")
def _(spark, r):
    at = norm.utc_timestamp(F.col("at"), milliseconds=True)
    return r.select("id", norm.company_status(F.col("status")).alias("status"), norm.suppression_kind(F.col("reason"), F.col("kind")).alias("kind"), norm.match_type(F.col("value"), F.col("hint")).alias("type"), norm.clean_cell(F.col("cell")).alias("cell"), norm.canonical_title(F.col("title"), TITLES).alias("title"), F.unix_millis(at).alias("ms"))


@query("phone_spellings", {"r": "SELECT c_custkey AS id, '98' || (10000000 + c_custkey) AS nat FROM {customer}"}, "SELECT id, '+91' || nat || ' 91' || nat || ' 0' || nat || ' ' || nat AS spellings FROM r")
def _(spark, r):
    return r.select("id", F.array_join(norm.phone_variants(F.concat(F.lit("+91"), "nat")), " ").alias("spellings"))


