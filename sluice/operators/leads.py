"""Plans for leads: what is pushed, held back, moved, rebalanced, pulled or suppressed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.patterns import take_by_demand
from sluice.functions.ranks import placed


def first_of(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check that holds, null if none does."""
    out = F.lit(None).cast("string")
    for name, hit in reversed(checks):
        out = F.when(F.coalesce(hit, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def push_plan(leads: DataFrame, checks: list[tuple[str, Column]], blocked: DataFrame, hits: DataFrame, key: str, order: list[Column], reps: list[str]) -> DataFrame:
    """lead, held, place, rep: leads that nothing holds back, dealt to reps in turn in one order of all of them, and the reason that holds back each other.

    Reasons, the first that holds: a check, a block (lead), a hit in a portal (lead), another lead of the same key before it in
    the file (row) that has passed all that. Places come from ranges of the order, so a plan of any length spreads over tasks.
    """
    b, h = blocked.select(F.col("lead").alias("_b")).distinct(), hits.select(F.col("lead").alias("_h")).distinct()
    rows = leads.join(b, leads["lead"] == b["_b"], "left").join(h, leads["lead"] == h["_h"], "left")
    rows = rows.withColumn("held", first_of([*checks, ("suppressed", F.col("_b").isNotNull()), ("in_portal", F.col("_h").isNotNull())]))
    first = rows.filter("held IS NULL").groupBy(F.col(key).alias("_k")).agg(F.min("row").alias("_first"))
    rows = rows.join(first, rows[key] == first["_k"], "left").withColumn("held", F.coalesce("held", F.when(F.col("row") != F.col("_first"), "duplicate_in_file")))
    plan = placed(rows.filter("held IS NULL").select(*leads.columns), [], order, "place")
    plan = plan.select("lead", F.lit(None).cast("string").alias("held"), "place", F.element_at(F.array(*map(F.lit, reps)), (F.col("place") % len(reps)).cast("int") + 1).alias("rep"))
    out = rows.filter("held IS NOT NULL").select("lead", "held", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("rep"))
    return plan.unionByName(out)


def campaign_chain(leads: DataFrame, checks: list[tuple[str, Column]], suppressed: DataFrame, hits: DataFrame) -> DataFrame:
    """lead, status, detail: the first of no key, a failed check, a row of the same key before it, suppression (its status) and a hit in a portal (why), else ok.

    suppressed: lead, status; hits: lead, why.
    """
    first = leads.filter(F.col("key").isNotNull()).groupBy(F.col("key").alias("_k")).agg(F.min("row").alias("_first"))
    s, h = suppressed.select(F.col("lead").alias("_s"), F.col("status").alias("_status")), hits.select(F.col("lead").alias("_h"), "why")
    rows = leads.join(first, leads["key"] == first["_k"], "left").join(s, leads["lead"] == s["_s"], "left").join(h, leads["lead"] == h["_h"], "left")
    held = first_of([("no_key", F.col("key").isNull()), *checks, ("duplicate_in_file", F.col("row") != F.col("_first")), ("suppressed", F.col("_status") != "clear"), ("in_portal", F.col("why").isNotNull())])
    detail = F.when(F.col("status") == "suppressed", F.col("_status")).when(F.col("status") == "in_portal", F.col("why"))
    return rows.withColumn("status", F.coalesce(held, F.lit("ok"))).select("lead", "status", detail.alias("detail"))


def rebalance(deals: DataFrame, reserve: DataFrame, reps: DataFrame, target: int) -> tuple[DataFrame, DataFrame]:
    """(moves, summary) that bring each rep's deals to the target: deal, from_rep, to_rep, action; rep, live, excess, need, filled, shortfall.

    A rep above the target gives up its first deals in order; the reserve (deal, from_rep) is given out before these are, in
    order of deal, never to the rep that a deal came from, since only reps below the target take and these have given up none;
    reserved deals of a rep that takes stay in the reserve. reps: rep, every rep once.
    """
    counts = reps.join(deals.groupBy("rep").agg(F.count("*").alias("n")), "rep", "left").select("rep", F.coalesce("n", F.lit(0)).alias("live"))
    counts = counts.withColumns({"excess": F.greatest(F.lit(0), F.col("live") - target), "need": F.greatest(F.lit(0), target - F.col("live"))})
    ranked = placed(deals, ["rep"], [F.col("deal")], "_n").join(F.broadcast(counts.select("rep", "excess")), "rep")
    given = ranked.filter("_n < excess").select("deal", F.col("rep").alias("from_rep"))
    takers = counts.filter("need > 0").select(F.col("rep").alias("from_rep"))
    pool = reserve.join(F.broadcast(takers), "from_rep", "left_anti").select("deal", "from_rep", F.lit(0).alias("first")).unionByName(given.withColumn("first", F.lit(1))).withColumn("_all", F.lit(1))
    demand = counts.select(F.lit(1).alias("_all"), F.col("rep").alias("to_rep"), "need")
    filled = take_by_demand(pool, demand, ["_all"], [F.col("first"), F.col("deal")], [F.col("to_rep")], "need")
    moves = given.select("deal", "from_rep", F.lit(None).cast("string").alias("to_rep"), F.lit("reserve").alias("action")).unionByName(filled.select("deal", "from_rep", "to_rep", F.lit("fill").alias("action")))
    got = filled.groupBy(F.col("to_rep").alias("rep")).agg(F.count("*").alias("filled"))
    summary = counts.join(got, "rep", "left").withColumn("filled", F.coalesce("filled", F.lit(0)))
    return moves, summary.withColumn("shortfall", F.col("need") - F.col("filled"))


def move_plan(leads: DataFrame, eligible: Column, hits: DataFrame, targets: DataFrame, order: list[Column]) -> DataFrame:
    """lead, portal: eligible leads that no portal has, in order, to portals up to their targets (portal, position, need), the first portal first."""
    clear = leads.filter(eligible).join(hits.select("lead").distinct(), "lead", "left_anti").withColumn("_all", F.lit(1))
    taken = take_by_demand(clear, targets.withColumn("_all", F.lit(1)), ["_all"], order, [F.col("position")], "need")
    return taken.select("lead", "portal")


def pull_plan(sheets: DataFrame, rules: list[tuple[str, Column, str, str]], default: tuple[str, str, str]) -> DataFrame:
    """sheet, class, action, reason by the first rule (class, when, action, reason) that holds."""
    pick = lambda k: F.coalesce(first_of([(r[k], r[1]) for r in rules]), F.lit(default[0 if k == 0 else k - 1]))
    return sheets.select("sheet", pick(0).alias("class"), pick(2).alias("action"), pick(3).alias("reason"))


def suppressions_from_pushes(pushes: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(kind, type, value, pushes of each new suppression; push, problem of the others): a status that means one, by the first there is of domain, LinkedIn address, name and note name."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("status"))
    made = lambda t, c: F.when(F.col(c).isNotNull() & (F.trim(c) != ""), F.struct(F.lit(t).alias("type"), F.col(c).alias("value")))
    rows = pushes.withColumns({"kind": kind, "m": F.coalesce(made("domain", "domain"), made("linkedin_company", "linkedin"), made("company_name", "name"), made("company_name", "note"))})
    problem = F.when(F.col("kind").isNull(), "no_kind").when(F.col("m").isNull(), "nothing_to_match")
    good = rows.filter("kind IS NOT NULL AND m IS NOT NULL").groupBy("kind", "m.type", "m.value").agg(F.count("*").alias("pushes"))
    return good, rows.select("push", problem.alias("problem")).filter("problem IS NOT NULL")


def scoped_suppression(leads: DataFrame, blocks: DataFrame, columns: dict[str, str], as_of: str) -> DataFrame:
    """lead, kind, scope of the blocks a lead meets: active, unexpired, global or of the lead's own account; a company is probed by its id like any value."""
    from sluice.operators.gates import probes

    at = F.lit(as_of).cast("date")
    active = blocks.filter(F.col("is_active") & (F.col("expires").isNull() | (F.col("expires") > at))).select("kind", "value", F.col("account").alias("_account")).distinct()
    rows = probes(leads, columns).join(leads.select("lead", "account"), "lead").join(active, ["kind", "value"])
    rows = rows.filter(F.col("_account").isNull() | (F.col("_account") == F.col("account")))
    return rows.select("lead", "kind", F.when(F.col("_account").isNull(), "global").otherwise("account").alias("scope")).distinct()


def available(pool: DataFrame, order: list[Column]) -> DataFrame:
    """The pool's available rows with their place, the oldest first."""
    return placed(pool.filter("status = 'available'"), [], order, "place")


def priority_picks(picks: DataFrame, runs: DataFrame, most: int) -> DataFrame:
    """Picks of finished runs, up to a priority."""
    return picks.join(runs.filter("status = 'done'").select("run"), "run", "left_semi").filter(F.col("priority") <= most)


def top_entries(counts: DataFrame, key: str, term: str, n: str, most: int = 8) -> DataFrame:
    """key, terms: its most frequent terms as term:n, joined, ties in order of the term. Only the first `most` of each task's rows are kept on the way."""
    w = Window.partitionBy(key).orderBy(F.col(n).desc(), term)
    top = counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most)
    spelt = F.concat_ws(":", term, F.col(n).cast("string"))
    return top.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", spelt.alias("t")))), lambda x: x["t"]), " ").alias("terms"))


def last_of(rows: DataFrame, series: str, at: str, most: int) -> DataFrame:
    """The last `most` rows of each series by `at`, with their place from the last one, 1."""
    w = Window.partitionBy(series).orderBy(F.col(at).desc())
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def by_list(rows: DataFrame, column: str, order: list[str], ties: list[Column]) -> DataFrame:
    """rows with place: in the order of a list, values that aren't in it last."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    return placed(rows.withColumn("_at", F.when(at > 0, at).otherwise(len(order) + 1)), [], [F.col("_at"), *ties], "place").drop("_at")
