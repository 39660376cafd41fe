"""Ledger and data-quality queries: line items as calls, orders as grants and meter readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import ledger as lg
from sluice.operators import quality as dq
from sluice.plans import model
from sluice.plans.model import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
RATES = [("r0", 1, 1, False), ("r1", 1, 2, True), ("r2", 0, 5, False), ("r3", 2, 2, True)]
C = "c AS (SELECT l_orderkey AS call, l_linenumber AS line, 'r' || (l_partkey % 5) AS endpoint, CAST(l_quantity AS BIGINT) AS rows, l_suppkey % 4 AS account, l_shipdate AS called_at, CAST(l_shipdate AS DATE) AS day, l_returnflag AS outcome, CAST(l_quantity AS BIGINT) % 7 AS credits FROM lineitem)"


def calls(spark, d):
    x = table(spark, d, "lineitem")
    return x.select(
        F.col("l_orderkey").alias("call"), F.col("l_linenumber").alias("line"), F.concat(F.lit("r"), (F.col("l_partkey") % 5).cast("string")).alias("endpoint"), F.col("l_quantity").cast("long").alias("rows"),
        (F.col("l_suppkey") % 4).alias("account"), F.col("l_shipdate").alias("called_at"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_returnflag").alias("outcome"), (F.col("l_quantity").cast("long") % 7).alias("credits"),
    )


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


RT = f"rt AS ({model.values_sql(RATES, 'endpoint, low, high, per_row')})"


@query("cost_of_calls", f"WITH {C}, {RT} SELECT c.endpoint, count(*) AS calls, CAST(sum(coalesce(low * CASE WHEN per_row THEN rows ELSE 1 END, 0)) AS BIGINT) AS min_credits, CAST(sum(coalesce(high * CASE WHEN per_row THEN rows ELSE 1 END, 0)) AS BIGINT) AS max_credits FROM c LEFT JOIN rt ON c.endpoint = rt.endpoint GROUP BY c.endpoint")
def _(spark, d):
    rows = lg.cost_of(calls(spark, d), spark.sql(model.values_sql(RATES, "endpoint, low, high, per_row")))
    return rows.groupBy("endpoint").agg(F.count("*").alias("calls"), F.sum("min_credits").alias("min_credits"), F.sum("max_credits").alias("max_credits"))


@query("charge_basis", f"WITH {C} SELECT basis, count(*) AS calls, CAST(sum(k) AS BIGINT) AS credits FROM (SELECT CASE WHEN credits > 3 THEN 'measured' WHEN endpoint <> 'r4' THEN 'rule' ELSE 'unknown' END AS basis, CASE WHEN credits > 3 THEN credits - 3 WHEN endpoint <> 'r4' THEN rows END AS k FROM c) GROUP BY basis")
def _(spark, d):
    rows = calls(spark, d).select(lg.charge_basis(F.col("credits") - 3, F.when(F.col("endpoint") != "r4", F.col("rows"))).alias("b"))
    return rows.groupBy("b.basis").agg(F.count("*").alias("calls"), F.sum("b.credits").alias("credits"))


@query("ledger_daily", f"WITH {C}, a AS (SELECT day, count(*) AS calls, count(*) FILTER (outcome = 'A') AS used, count(*) FILTER (outcome = 'R') AS discarded, CAST(sum(credits) AS BIGINT) AS credits FROM c GROUP BY day) SELECT *, CAST(sum(credits) OVER (PARTITION BY year(day) ORDER BY day) AS BIGINT) AS year_to_date FROM a")
def _(spark, d):
    return lg.daily_audit(calls(spark, d), "day", "outcome", "credits")


@query("ledger_report_by", f"WITH {C} SELECT endpoint, count(*) AS calls, CAST(sum(credits) AS BIGINT) AS credits, CAST(grouping(endpoint) AS INT) AS is_total FROM c GROUP BY ROLLUP (endpoint)")
def _(spark, d):
    return lg.report_by(calls(spark, d), "endpoint", "credits")


@query("unlogged_credits", f"WITH {C}, rd AS (SELECT account, read_at, CAST(sum(m) OVER (PARTITION BY account ORDER BY read_at) AS BIGINT) AS meter FROM (SELECT o_custkey % 4 AS account, o_orderdate AS read_at, CAST(count(*) * 30 AS BIGINT) AS m FROM orders GROUP BY ALL)), mv AS (SELECT account, read_at, meter - lag(meter) OVER w AS used, lag(read_at) OVER w AS since FROM rd WINDOW w AS (PARTITION BY account ORDER BY read_at)), lo AS (SELECT c.account, r.read_at, CAST(sum(credits) AS BIGINT) AS logged FROM c ASOF JOIN rd r ON c.account = r.account AND c.called_at <= r.read_at GROUP BY ALL) SELECT mv.account, mv.read_at, used, coalesce(logged, 0) AS logged, used - coalesce(logged, 0) AS unlogged FROM mv LEFT JOIN lo ON mv.account = lo.account AND mv.read_at = lo.read_at WHERE used IS NOT NULL")
def _(spark, d):
    from pyspark.sql import Window

    o = table(spark, d, "orders").groupBy((F.col("o_custkey") % 4).alias("account"), F.col("o_orderdate").alias("read_at")).agg((F.count("*") * 30).alias("m"))
    readings = o.withColumn("meter", F.sum("m").over(Window.partitionBy("account").orderBy("read_at"))).drop("m")
    return lg.unlogged(readings, calls(spark, d))


SPEND = "SELECT o_orderkey, o_orderdate AS start, o_orderdate + to_minutes(CAST(o_orderkey % 4000 AS INT)) AS end_, CAST(o_custkey % 9 AS DOUBLE) AS credits FROM orders"


@query("spread_intervals", f"WITH s AS ({SPEND}), o AS (SELECT s.*, x.o AS off, epoch(start)::BIGINT // 60 + x.o AS lo, epoch(end_)::BIGINT // 60 + x.o AS hi FROM s, (VALUES (0), (330)) AS x(o)), y AS (SELECT *, unnest(range(lo // 1440, hi // 1440 + 1)) AS d FROM o) SELECT CAST(off AS INT) AS \"offset\", DATE '1970-01-01' + CAST(d AS INT) AS day, round(sum(credits * (least(hi, d * 1440 + 1439) - greatest(lo, d * 1440) + 1) / (hi - lo + 1)), 6) AS credits FROM y GROUP BY ALL")
def _(spark, d):
    o = table(spark, d, "orders")
    spend = o.select(F.col("o_orderdate").alias("start"), F.expr("timestampadd(MINUTE, cast(o_orderkey % 4000 as int), o_orderdate)").alias("end"), (F.col("o_custkey") % 9).cast("double").alias("credits"))
    return lg.spread_intervals(spend, [0, 330])


@query("tam_coverage", "WITH p AS (SELECT o_custkey % 50 AS filter, max(o_orderkey % 900 + 1) AS reported, count(*) AS pages FROM orders GROUP BY ALL), q AS (SELECT l_suppkey % 40 AS filter, count(DISTINCT l_partkey) AS people FROM lineitem GROUP BY ALL) SELECT p.filter, reported, pages, coalesce(people, 0) AS people, round(100.0::DOUBLE * coalesce(people, 0) / reported, 1) AS pct, greatest(0, reported - coalesce(people, 0)) AS remaining FROM p LEFT JOIN q ON p.filter = q.filter")
def _(spark, d):
    pages = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("filter"), (F.col("o_orderkey") % 900 + 1).alias("reported"))
    return lg.coverage(pages, table(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("filter"), F.col("l_partkey").alias("person")))


@query("validate_rejected", "SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN NOT l_quantity <= 45 THEN 'quantity' END, CASE WHEN NOT l_returnflag IN ('A', 'N') THEN 'flag' END, CASE WHEN NOT l_discount < 0.09 THEN 'discount' END], lambda x: x IS NOT NULL), ',') AS failed FROM lineitem WHERE NOT (l_quantity <= 45 AND l_returnflag IN ('A', 'N') AND l_discount < 0.09)")
def _(spark, d):
    bad = dq.validate(table(spark, d, "lineitem"), {"quantity": F.col("l_quantity") <= 45, "flag": F.col("l_returnflag").isin("A", "N"), "discount": F.col("l_discount") < 0.09})[1]
    return bad.select("l_orderkey", "l_linenumber", F.array_join("failed", ",").alias("failed"))


@query("dq_upsert", "WITH b AS (SELECT CASE WHEN c_custkey % 300 < 200 THEN 'f' ELSE 'old' END || c_custkey % 300 AS fingerprint, CASE WHEN max(c_custkey) % 3 = 0 THEN 'resolved' ELSE 'open' END AS status, count(*) AS occurrences FROM customer GROUP BY ALL), n AS (SELECT CASE WHEN o_custkey % 300 >= 100 THEN 'f' ELSE 'new' END || o_custkey % 300 AS fingerprint, count(*) AS n FROM orders GROUP BY ALL) SELECT coalesce(b.fingerprint, n.fingerprint) AS fingerprint, CASE WHEN n.n IS NOT NULL THEN 'open' ELSE 'resolved' END AS status, coalesce(occurrences, 0) + coalesce(n.n, 0) AS occurrences, CASE WHEN b.status IS NULL THEN 'new' WHEN n.n IS NOT NULL AND b.status = 'resolved' THEN 'reopened' WHEN n.n IS NOT NULL THEN 'seen' WHEN b.status = 'open' THEN 'resolved' ELSE 'unchanged' END AS action FROM b FULL JOIN n ON b.fingerprint = n.fingerprint")
def _(spark, d):
    name = lambda c, known, other: F.concat(F.when(known, "f").otherwise(other), (F.col(c) % 300).cast("string")).alias("fingerprint")
    c = table(spark, d, "customer").groupBy(name("c_custkey", F.col("c_custkey") % 300 < 200, "old")).agg(F.max("c_custkey").alias("m"), F.count("*").alias("occurrences"))
    before = c.withColumn("status", F.when(F.col("m") % 3 == 0, "resolved").otherwise("open"))
    return dq.upsert_findings(before, table(spark, d, "orders").select(name("o_custkey", F.col("o_custkey") % 300 >= 100, "new")))


@query("count_reconcile", "WITH a AS (SELECT o_custkey AS k, count(*) AS l FROM orders GROUP BY k), b AS (SELECT c_custkey AS k, count(*) AS r FROM customer GROUP BY k) SELECT coalesce(a.k, b.k) AS k, coalesce(l, 0) AS left, coalesce(r, 0) AS right, coalesce(r, 0) - coalesce(l, 0) AS delta FROM a FULL JOIN b ON a.k = b.k")
def _(spark, d):
    return dq.reconcile(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k")), ["k"])


@query("set_reconciliation", "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END AS k FROM customer) SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left' ELSE 'right' END AS side FROM a FULL JOIN b ON a.k = b.k")
def _(spark, d):
    return dq.set_diff(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.when(F.col("c_custkey") % 7 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("k")), "k")


@query("snapshot_diff", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'insert' WHEN c_custkey % 11 = 0 THEN 'delete' WHEN c_custkey % 13 = 0 THEN 'update' ELSE 'unchanged' END AS action FROM customer")
def _(spark, d):
    c = table(spark, d, "customer")
    after = c.filter("c_custkey % 11 <> 0 OR c_custkey % 10 = 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 13 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return dq.row_diff(c.filter("c_custkey % 10 <> 0"), after, ["c_custkey"])


@query("referential_orphans", "SELECT 'orders.o_custkey' AS link, count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END FROM customer) UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT CASE WHEN s_suppkey % 2 = 1 THEN -s_suppkey ELSE s_suppkey END FROM supplier)")
def _(spark, d):
    t = {n: table(spark, d, n) for n in ("orders", "lineitem", "customer", "supplier")}
    t |= {"customer": t["customer"].withColumn("c_custkey", F.when(F.col("c_custkey") % 3 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))), "supplier": t["supplier"].withColumn("s_suppkey", F.when(F.col("s_suppkey") % 2 == 1, -F.col("s_suppkey")).otherwise(F.col("s_suppkey")))}
    return dq.orphans(t, [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey")])


@query("table_profile", " UNION ALL ".join(f"SELECT 'orders' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count({c}) AS filled FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))
def _(spark, d):
    return dq.profile(table(spark, d, "orders"), "orders")


@query("mirror_parity", "SELECT 'source' AS side, count(*) AS rows FROM lineitem WHERE l_orderkey % 17 = 0 UNION ALL SELECT 'mirror', count(*) FROM lineitem WHERE l_orderkey % 17 = 0")
def _(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dq.parity(x, x.withColumn("l_quantity", F.when(F.col("l_orderkey") % 17 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity"))))


@query("tally_examples", "SELECT l_returnflag, n, examples FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) JOIN (SELECT l_returnflag AS f, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) AS r FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem)) WHERE r <= 3 GROUP BY 1) ON l_returnflag = f")
def _(spark, d):
    return dq.tally(table(spark, d, "lineitem"), "l_returnflag", "l_orderkey")


@query("source_health", "SELECT l_shipdate::DATE AS day, count(*) AS attempts, count(*) FILTER (l_returnflag = 'N') AS ok, count(*) FILTER (l_returnflag = 'R') AS failed, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS modes FROM lineitem GROUP BY day")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("attempts"), F.count_if(F.col("l_returnflag") == "N").alias("ok"), F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("modes"))


@query("top_k_per_group", "SELECT l_suppkey, l_orderkey, l_linenumber, r FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INT) AS r FROM lineitem) WHERE r <= 3")
def _(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber")
    return table(spark, d, "lineitem").withColumn("r", F.row_number().over(w)).filter("r <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "r")
