"""Audits of the store: provenance, open findings, drift of labels and configuration, parity, and the summary of all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def origin_coverage(entities: dict[str, tuple[DataFrame, str]], origins: DataFrame) -> DataFrame:
    """entity_type, rows, without_origin of each table (frame, key) against origins (entity_type, entity_id), one join for all."""
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(t).alias("entity_type"), F.col(k).alias("entity_id")) for t, (df, k) in entities.items()])
    known = origins.select("entity_type", "entity_id", F.lit(True).alias("_o")).distinct()
    met = rows.join(known, ["entity_type", "entity_id"], "left")
    return met.groupBy("entity_type").agg(F.count("*").alias("rows"), F.count_if(F.col("_o").isNull()).alias("without_origin"))


def open_findings(findings: DataFrame) -> DataFrame:
    """rule, severity, issues, occurrences, last_seen of findings that are open or acknowledged."""
    live = findings.filter(F.col("status").isin("open", "acknowledged"))
    return live.groupBy("rule", "severity").agg(F.count("*").alias("issues"), F.sum("occurrences").alias("occurrences"), F.max("last_seen").alias("last_seen"))


def map_problems(stage_map: DataFrame, derived: list[str]) -> DataFrame:
    """stage_id, problem: a mapping to a rung that is derived, a reason without DEAD, DEAD without a reason or without the depth it reached."""
    dead = F.col("rung") == "DEAD"
    rules = [("derived_rung", F.col("rung").isin(*derived)), ("reason_without_dead", ~dead & F.col("reason").isNotNull()), ("dead_without_reason", dead & F.col("reason").isNull()), ("dead_without_depth", dead & F.col("depth_reached").isNull())]
    found = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in rules]))
    return stage_map.select("stage_id", F.explode(found).alias("problem"))


def label_drift(before: DataFrame, now: DataFrame) -> DataFrame:
    """id, label, previous: ids whose label changed, with the labels they had, the one just replaced last. before: id, label, previous (array)."""
    n = now.select(F.col("id").alias("_id"), F.col("label").alias("_now"))
    rows = before.join(n, before["id"] == n["_id"]).filter(~F.col("label").eqNullSafe(F.col("_now"))).withColumnRenamed("label", "_was")
    kept = F.filter("previous", lambda x: ~x.eqNullSafe(F.col("_was")))
    return rows.select("id", F.col("_now").alias("label"), F.array_append(kept, F.col("_was")).alias("previous"))


def reference_drift(config: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """key, column, configured, stored: what a configured list says that the stored table doesn't, missing and extra rows too (column null)."""
    columns = [c for c in config.columns if c != key]
    a, b = (d.select(F.col(key), *[F.col(c).cast("string").alias(f"{s}{c}") for c in columns], F.lit(True).alias(f"{s}there")) for d, s in ((config, "_a_"), (table, "_b_")))
    rows = a.join(b, key, "full")
    one = F.col("_a_there").isNull() | F.col("_b_there").isNull()
    both = F.col("_a_there") & F.col("_b_there")
    odd = [F.when(both & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").alias("configured"), F.col(f"_b_{c}").alias("stored"))) for c in columns]
    whole = F.when(one, F.struct(F.lit(None).cast("string").alias("column"), F.when(F.col("_a_there"), "row").alias("configured"), F.when(F.col("_b_there"), "row").alias("stored")))
    return rows.select(key, F.explode(F.array_compact(F.array(whole, *odd))).alias("d")).select(key, "d.*")


def excluded_rows(rows: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """key, reason, rows: stored rows of a source that is excluded."""
    return rows.join(excluded, key).groupBy(key, "reason").agg(F.count("*").alias("rows"))


def verbatim_parity(source: DataFrame, mirror: DataFrame, key: str) -> DataFrame:
    """check, source, mirror, ok: rows, values of each column that are there, and the sum of the keys, on both sides; one pass over each."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        parts = [F.struct(F.lit("rows").alias("check"), F.count("*").cast("decimal(38,0)").alias("n")), F.struct(F.lit("key_sum").alias("check"), F.coalesce(F.sum(F.col(key).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("n"))]
        parts += [F.struct(F.lit(f"filled:{c}").alias("check"), F.count(c).cast("decimal(38,0)").alias("n")) for c in df.columns]
        return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.check", F.col("p.n").cast("long").alias(name))

    rows = counts(source, "source").join(counts(mirror, "mirror"), "check", "full")
    return rows.withColumn("ok", F.col("source").eqNullSafe(F.col("mirror")))


def id_diff(left: DataFrame, right: DataFrame, key: str, reasons: list[tuple[str, Column]]) -> DataFrame:
    """side (both, left or right), reason, n of ids: why an id is on one side only is the first reason that holds for its row."""
    a, b = left.withColumn("_l", F.lit(True)), right.select(F.col(key).alias("_key"), F.lit(True).alias("_r")).distinct()
    met = a.join(b, a[key] == b["_key"], "full")
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")
    why = F.lit("unexplained")
    for name, hit in reversed(reasons):
        why = F.when(F.coalesce(hit, F.lit(False)), name).otherwise(why)
    rows = met.withColumns({"side": side, "reason": F.when(side == "both", F.lit(None).cast("string")).when(side == "right", "unknown_here").otherwise(why)})
    return rows.groupBy("side", "reason").agg(F.count("*").alias("n"))


def doctor(checks: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """check, n, status: the rows of each check's frame; warn if there are more than are allowed, else ok."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n", F.when(F.col("n") > most, "warn").otherwise("ok").alias("status")) for name, (df, most) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def freshness(states: DataFrame, now: str) -> DataFrame:
    """source, last_success, hours: hours since each source's last success at a given time, to two places."""
    last = states.groupBy("source").agg(F.max(F.when(F.col("ok"), F.col("at"))).alias("last_success"))
    seconds = F.timestamp_diff("SECOND", F.col("last_success"), F.lit(now).cast("timestamp_ntz"))
    return last.select("source", "last_success", F.round(seconds / 3600.0, 2).alias("hours"))


def account_scores(companies: DataFrame, scores: DataFrame, indicators: DataFrame, sources: DataFrame) -> DataFrame:
    """company, score, band of its latest score, and how many indicators and sources it has; each side is summed before it is joined."""
    last = scores.groupBy("company").agg(F.max_by(F.struct("score", "band"), F.struct("at", "score")).alias("s"))
    ind = indicators.groupBy("company").agg(F.countDistinct("indicator").alias("indicators"))
    src = sources.groupBy("company").agg(F.countDistinct("source").alias("sources"))
    rows = companies.select("company").join(last, "company", "left").join(ind, "company", "left").join(src, "company", "left")
    return rows.select("company", "s.score", "s.band", F.coalesce("indicators", F.lit(0)).alias("indicators"), F.coalesce("sources", F.lit(0)).alias("sources"))


def source_attempts(attempts: DataFrame) -> DataFrame:
    """source, attempts, ok, failed, blocked, rows, last_at, modes: how each source does and the ways in which it fails."""
    bad = F.col("outcome") == "failed"
    return attempts.groupBy("source").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(bad).alias("failed"), F.count_if(F.col("outcome") == "blocked").alias("blocked"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("at").alias("last_at"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("mode")))), ",").alias("modes"))


def add_signals(rows: DataFrame, codes: list[str], key: str, source: str, at: str) -> DataFrame:
    """key, code, value, source, at: a row for each filled column; of rows with equal key, code, source and time the first by `row` stays."""
    long = rows.unpivot([key, source, at, "row"], codes, "code", "value").filter("value IS NOT NULL AND trim(value) <> ''")
    return long.groupBy(key, "code", source, at).agg(F.min_by("value", "row").alias("value"))


def imported_verdicts(rows: DataFrame, buckets: dict[str, str], known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verdicts, problems): id, company, bucket, confidence, reason, method, is_current; and id, problem of unknown buckets, confidences outside 0 to 1 and companies that aren't there.

    Unknown buckets count as unscored and bad confidences as none. A reason that is an object isn't one, the notes are then.
    A rules verdict has no model bucket. The first decision of a company and vertical by time, then id, is the current one.
    """
    there = known.select(F.col("company").alias("_c"), F.lit(True).alias("_there"))
    mapped = F.try_element_at(F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair]), F.col("native"))
    conf = F.coalesce("confidence", "model_confidence")
    rows = rows.join(there, rows["company"] == there["_c"], "left").withColumns({"_bucket": mapped, "_conf": conf})
    good_conf = F.when(F.col("_conf").between(0, 1), F.col("_conf"))
    reason = F.when(F.col("why").isNotNull() & ~F.startswith(F.col("why"), F.lit("{")) & (F.trim("why") != ""), F.col("why")).otherwise(F.nullif(F.trim("notes"), F.lit("")))
    w = Window.partitionBy("company", "vertical").orderBy("decided_at", "id")
    verdicts = rows.filter("_there").select("id", "company", "vertical", F.coalesce("_bucket", F.lit("unscored")).alias("bucket"), good_conf.alias("confidence"), reason.alias("reason"), F.when(F.col("model_bucket").isNotNull(), "llm").otherwise("rules").alias("method"), (F.row_number().over(w) == 1).alias("is_current"))
    odd = F.array_compact(F.array(F.when(F.col("_there").isNull(), F.lit("company_missing")), F.when(F.col("native").isNotNull() & F.col("_bucket").isNull(), F.lit("unknown_bucket")), F.when(F.col("_conf").isNotNull() & ~F.col("_conf").between(0, 1), F.lit("confidence_out_of_range"))))
    return verdicts, rows.select("id", F.explode(odd).alias("problem"))


def score_components(scores: DataFrame, components: DataFrame) -> DataFrame:
    """score_id, total, parts: a score's components in their order, rule:points joined, and their sum; a score without any has none."""
    spelt = F.concat_ws(":", "rule", F.col("points").cast("string"))
    parts = components.groupBy("score_id").agg(F.sum("points").alias("total"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", spelt.alias("t")))), lambda x: x["t"]), " ").alias("parts"))
    return scores.select("score_id").join(parts, "score_id", "left").select("score_id", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("parts", F.lit("")).alias("parts"))


def imported_costs(rows: DataFrame, credits_per_call: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """(costs, problems): id, vendor, unit, calls, credits, usd, basis; a price of 0 is unknown, never free; rows without vendor, unit or a quantity of 0 and more are rejected."""
    per = F.try_element_at(F.create_map(*[F.lit(x) for pair in credits_per_call.items() for x in pair]), F.col("unit"))
    ok = F.coalesce((F.trim("vendor") != "") & F.col("unit").isNotNull() & (F.col("qty") >= 0), F.lit(False))
    usd = F.when(F.col("usd") > 0, F.col("usd"))
    costs = rows.filter(ok).select("id", F.lower(F.trim("vendor")).alias("vendor"), "unit", F.coalesce(F.col("qty") / per, F.col("qty")).alias("calls"), F.col("qty").alias("credits"), usd.alias("usd"), F.when(usd.isNotNull(), "estimated").otherwise("unknown").alias("basis"))
    return costs, rows.filter(~ok).select("id", F.lit("rejected").alias("problem"))


def merged_ledgers(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """rows of the one source that a period rule (repo, source, from_day, to_day, both open if null) names for their repo, with `estimated`: as the notes say, else by the kind of evidence."""
    p = periods.select(F.col("repo").alias("_r"), F.col("source").alias("_s"), "from_day", "to_day")
    hit = (rows["repo"] == p["_r"]) & (rows["source"] == p["_s"]) & (F.col("from_day").isNull() | (rows["day"] >= F.col("from_day"))) & (F.col("to_day").isNull() | (rows["day"] < F.col("to_day")))
    kept = rows.join(F.broadcast(p), hit, "left_semi").filter("credits <> 0")
    said = F.when(F.contains("notes", F.lit("[ESTIMATED]")), True).when(F.contains("notes", F.lit("[MEASURED]")), False)
    return kept.withColumn("estimated", F.coalesce(said, F.col("evidence").isin("code_estimate", "chat_claim"), F.lit(False)))


def best_offset(spent: DataFrame, chart: DataFrame) -> DataFrame:
    """offset, overshoot of the offset whose spending by day (offset, day, credits) is least above the chart's (day, credits), the smallest of equal ones."""
    c = chart.select(F.col("day").alias("_day"), F.col("credits").alias("_chart"))
    over = spent.join(c, spent["day"] == c["_day"], "left").groupBy("offset").agg(F.round(F.sum(F.greatest(F.lit(0.0), F.col("credits") - F.coalesce("_chart", F.lit(0.0)))), 6).alias("overshoot"))
    return over.agg(F.min(F.struct("overshoot", "offset")).alias("m")).select("m.offset", "m.overshoot")


def dot_to_dot(readings: DataFrame, grants: DataFrame) -> DataFrame:
    """account, from_at, to_at, moved, granted, used between one meter reading and the next: what was used is what the meter lost and what was granted in between."""
    from sluice.functions.patterns import asof_join

    w = Window.partitionBy("account").orderBy("at")
    steps = readings.select("account", "at", "balance", F.lag("at").over(w).alias("from_at"), F.lag("balance").over(w).alias("_before")).filter("from_at IS NOT NULL")
    back = lambda c: -F.unix_micros(F.col(c).cast("timestamp"))
    ends = readings.select("account", back("at").alias("_b"), F.col("at").alias("_to"))
    given = asof_join(grants.withColumn("_t", back("granted_at")), ends, "account", "_t", "_b", "_to").groupBy("account", F.col("_to").alias("at")).agg(F.sum("credits").alias("granted"))
    rows = steps.join(given, ["account", "at"], "left").withColumn("granted", F.coalesce("granted", F.lit(0)))
    moved = F.col("balance") - F.col("_before")
    return rows.select("account", "from_at", F.col("at").alias("to_at"), moved.alias("moved"), "granted", (F.col("granted") - moved).alias("used"))


def leak_summary(leaks: DataFrame, fixes: DataFrame) -> DataFrame:
    """kind, leaks, fixed, open, credits: leaks by kind, and those that a fix has been written for."""
    rows = leaks.join(fixes.select("leak", F.lit(True).alias("_f")).distinct(), "leak", "left")
    return rows.groupBy("kind").agg(F.count("*").alias("leaks"), F.count_if("_f").alias("fixed"), F.count_if(F.col("_f").isNull()).alias("open"), F.sum("credits").alias("credits"))


def key_links(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """source, type, links: entities of a source that a key of this type linked to a company (labels of identity.golden)."""
    rows = entities.select("entity", "source").join(labels.filter("how <> 'new'").select("entity", F.col("how").alias("type")), "entity")
    return rows.groupBy("source", "type").agg(F.count("*").alias("links"))


def confirmed(owned: DataFrame) -> DataFrame:
    """type, identifiers: strong values that entities of two sources or more bring to the company that owns them (identity.owned)."""
    n = owned.filter("golden = owner").groupBy("type", "value").agg(F.countDistinct("source").alias("n"))
    return n.filter("n >= 2").groupBy("type").agg(F.count("*").alias("identifiers"))
