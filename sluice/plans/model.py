"""How the given tables become the funnel's model, in Spark and as SQL for DuckDB."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.patterns import ist_day

# The ladder of rungs (code, depth, attempt, connected, interested) and the reasons of dead deals.
RUNGS = [
    ("SOURCED", 0.0, False, False, False), ("LI_SENT", 0.5, False, False, False), ("NO_ANSWER", 1.0, True, False, False), ("LI_CONNECTED", 1.5, True, False, False),
    ("REPLIED", 2.0, True, True, False), ("INTERESTED", 3.0, True, True, True), ("MEETING_BOOKED", 4.0, True, True, True), ("MEETING_HELD", 5.0, False, False, False),
    ("ASSET_REQUESTED", 6.0, False, False, False), ("ASSET_RECEIVED", 7.0, False, False, False), ("EVALUATED", 8.0, False, False, False), ("NEGOTIATION", 9.0, False, False, False),
    ("CONTRACT", 10.0, False, False, False), ("DELIVERED", 11.0, False, False, False), ("PAYMENT", 12.0, False, False, False), ("WON", 13.0, False, False, False),
    ("DEAD", 100.0, False, False, False),
]
REASONS = [
    ("WRONG_FIT", False, False), ("BAD_CONTACT", True, False), ("NO_RESPONSE", True, False), ("NOT_INTERESTED", True, True), ("NO_SHOW", True, True),
    ("MEETING_CANCELLED", True, True), ("REJECTED", True, True), ("PRIVACY", True, True), ("COMMERCIAL", True, True), ("RETIRED_ADMIN", False, False),
]
#: Native stages of the given events -> rung, dead reason, depth reached, own flag for attempts. error_3 is left unmapped on purpose.
STAGE_MAP = [
    ("click_0", "SOURCED", None, None, None), ("click_1", "LI_SENT", None, None, None), ("click_2", "NO_ANSWER", None, None, None), ("click_3", "LI_CONNECTED", None, None, False),
    ("view_0", "REPLIED", None, None, None), ("view_1", "INTERESTED", None, None, None), ("view_2", "MEETING_BOOKED", None, None, None), ("view_3", "ASSET_REQUESTED", None, None, None),
    ("signup_0", "ASSET_RECEIVED", None, None, None), ("signup_1", "NEGOTIATION", None, None, None), ("signup_2", "CONTRACT", None, None, None), ("signup_3", "DELIVERED", None, None, None),
    ("purchase_0", "PAYMENT", None, None, None), ("purchase_1", "WON", None, None, None), ("purchase_2", "DEAD", "NOT_INTERESTED", 5.0, None), ("purchase_3", "DEAD", "WRONG_FIT", 2.0, True),
    ("error_0", "DEAD", "BAD_CONTACT", 1.0, None), ("error_1", "DEAD", "NO_SHOW", 4.0, None), ("error_2", "DEAD", "COMMERCIAL", 9.0, None),
]
HELD_REASONS = ("REJECTED", "NOT_INTERESTED", "PRIVACY")


def literal(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, float):
        return f"CAST({x!r} AS DOUBLE)" if math.isfinite(x) else "NULL"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def values_sql(rows: list[tuple], names: str) -> str:
    """SELECT of literal rows that both engines read."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS v({names})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "labels")


def derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Rows that a SELECT over {tables} derives from the given ones, in words that both engines read alike."""
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text})


def duck(text: str) -> str:
    """The same SELECT for DuckDB."""
    return text.format(**{t: t for t in TABLES})


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    e = table(spark, sf_dir, "events").withColumn("k", k)
    return e.select(
        "event_id", F.col("ts").alias("entered_at"), (F.col("user_id") * 7 + F.col("k") % 7).alias("deal_id"), F.concat_ws("_", "event_type", (F.col("k") % 4).cast("string")).alias("stage_id"),
        (F.col("user_id") % 5).alias("pipeline_id"), (F.col("user_id") % 3).alias("account_id"), F.when(F.col("k") % 3 != 0, F.col("k") % 10).alias("actor"), (F.col("k") % 3 != 0).alias("is_human"),
        ist_day(F.col("ts")).alias("ist_day"), "value",
    )


def stage_map(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(STAGE_MAP, "stage_id, rung, reason, depth_reached, own_attempt"))


def rungs(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(RUNGS, "code, depth, attempt, connected, interested"))


def reasons(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(REASONS, "code, attempt, connected"))


E = """e AS (SELECT event_id, ts AS entered_at, user_id * 7 + k % 7 AS deal_id, event_type || '_' || (k % 4) AS stage_id, user_id % 5 AS pipeline_id, user_id % 3 AS account_id,
CASE WHEN k % 3 <> 0 THEN k % 10 END AS actor, k % 3 <> 0 AS is_human, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS ist_day, value
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))"""
MAP = f"sm AS ({values_sql(STAGE_MAP, 'stage_id, rung, reason, depth_reached, own_attempt')}), rg AS ({values_sql(RUNGS, 'code, depth, attempt, connected, interested')}), rs AS ({values_sql(REASONS, 'code, attempt, connected')})"
X = """x AS (SELECT e.*, coalesce(sm.rung, 'UNMAPPED') AS rung, sm.reason, sm.depth_reached, rg.depth, coalesce(sm.own_attempt, rs.attempt, rg.attempt, false) AS attempt,
coalesce(rs.connected, rg.connected, false) AS connected, coalesce(rg.interested, false) AS interested
FROM e LEFT JOIN sm ON e.stage_id = sm.stage_id LEFT JOIN rg ON sm.rung = rg.code LEFT JOIN rs ON sm.reason = rs.code)"""
#: One deal for each deal_id: its first event's place, a creation day that is unknown for some, its last stage, some archived, some drifted.
D = """d AS (SELECT deal_id, min(account_id) AS account_id, min(pipeline_id) AS pipeline_id, CASE WHEN deal_id % 11 <> 0 THEN min(ist_day) - CAST(deal_id % 5 AS INT) END AS created_day,
CASE WHEN deal_id % 13 = 0 THEN 'click_0' ELSE arg_max(stage_id, event_id) END AS stage_id, deal_id % 17 = 0 AS is_archived,
CASE WHEN deal_id % 17 = 0 AND deal_id % 34 <> 0 THEN max(ist_day) - 3 + CAST(deal_id % 9 AS INT) END AS archived_day, 'c' || (deal_id % 40) AS company, CASE WHEN deal_id % 4 = 0 THEN NULL ELSE deal_id % 12 END AS owner,
CASE deal_id % 3 WHEN 0 THEN 'Cold India' WHEN 1 THEN 'Referral UK' END AS lead_source FROM e GROUP BY deal_id)"""


def funnel_sql(body: str) -> str:
    return f"WITH {E}, {MAP}, {X}, {D} {body}"


def deals(events: DataFrame) -> DataFrame:
    rows = events.groupBy("deal_id").agg(F.min("account_id").alias("account_id"), F.min("pipeline_id").alias("pipeline_id"), F.min("ist_day").alias("first_day"), F.max_by("stage_id", "event_id").alias("last_stage"), F.max("ist_day").alias("last_day"))
    return rows.select(
        "deal_id", "account_id", "pipeline_id", F.when(F.col("deal_id") % 11 != 0, F.date_sub("first_day", (F.col("deal_id") % 5).cast("int"))).alias("created_day"),
        F.when(F.col("deal_id") % 13 == 0, "click_0").otherwise(F.col("last_stage")).alias("stage_id"), (F.col("deal_id") % 17 == 0).alias("is_archived"),
        F.when((F.col("deal_id") % 17 == 0) & (F.col("deal_id") % 34 != 0), F.date_add("last_day", (F.col("deal_id") % 9 - 3).cast("int"))).alias("archived_day"),
        F.concat(F.lit("c"), (F.col("deal_id") % 40).cast("string")).alias("company"), F.when(F.col("deal_id") % 4 != 0, F.col("deal_id") % 12).alias("owner"),
        F.when(F.col("deal_id") % 3 == 0, "Cold India").when(F.col("deal_id") % 3 == 1, "Referral UK").alias("lead_source"),
    )
