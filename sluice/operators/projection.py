"""From raw and legacy rows to the model: who acted, stages that only history knows, verdicts, links, plans."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sluice.functions.staging import staged


def actor_owners(users: DataFrame) -> DataFrame:
    """account, user_id, owner_id: a user's owner; where there is none the equal id, but only in accounts in which all known pairs are equal."""
    equal = users.groupBy(F.col("account").alias("_a")).agg(F.coalesce(F.every(F.col("owner_id") == F.col("user_id")), F.lit(False)).alias("equal"))
    rows = users.join(equal, users["account"] == equal["_a"])
    return rows.select("account", "user_id", F.when(F.col("owner_id").isNotNull(), F.col("owner_id")).when(F.col("equal"), F.col("user_id")).alias("owner_id"))


def stub_stages(events: DataFrame, known: DataFrame) -> DataFrame:
    """stage_id, pipeline_id, events: stages seen in events alone, in the pipeline they are most in, the least of equal ones. The known stages are a list."""
    unseen = events.join(F.broadcast(known.select("stage_id")), "stage_id", "left_anti")
    n = unseen.groupBy("stage_id", "pipeline_id").agg(F.count("*").alias("n"))
    return n.groupBy("stage_id").agg(F.max_by("pipeline_id", F.struct("n", -F.col("pipeline_id"))).alias("pipeline_id"), F.sum("n").alias("events"))


def scope_counts(events: DataFrame, ignored: DataFrame) -> DataFrame:
    """state, events, deals: in reporting funnels, and in those left out of them."""
    rows = events.join(F.broadcast(ignored.withColumn("_i", F.lit(True))), "pipeline_id", "left")
    return rows.groupBy(F.when(F.col("_i"), "ignored").otherwise("reported").alias("state")).agg(F.count("*").alias("events"), F.countDistinct("deal_id").alias("deals"))


def current_verdicts(verdicts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """verdicts with is_current: the latest of each key, later arrivals first among equal times."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return verdicts.withColumn("is_current", F.row_number().over(w) == 1)


def source_pairs(entities: DataFrame, group: str, source: str) -> DataFrame:
    """left, right, n: groups that both sources have. Sources of a group are a short distinct list, paired inside its row."""
    lists = entities.groupBy(group).agg(F.array_sort(F.collect_set(source)).alias("s"))
    pairs = F.flatten(F.transform("s", lambda x, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda y: F.struct(x.alias("left"), y.alias("right")))))
    return lists.select(F.explode(pairs).alias("p")).groupBy("p.left", "p.right").agg(F.count("*").alias("n"))


def pushed(pushes: DataFrame, deals: DataFrame, survivors: DataFrame) -> DataFrame:
    """push, status: no_id, unmatched, agree or conflict with the company of the deal, after survivors of both."""
    rows = pushes.join(deals.select("deal", F.col("company").alias("_of")), "deal", "left")
    for side, column in (("_a", "company"), ("_b", "_of")):
        s = survivors.select(F.col("entity").alias(column), F.col("survivor").alias(side))
        rows = rows.join(s, column, "left")
    same = F.coalesce("_a", "company").eqNullSafe(F.coalesce("_b", "_of"))
    return rows.select("push", F.when(F.col("deal").isNull(), "no_id").when(F.col("_of").isNull(), "unmatched").when(same, "agree").otherwise("conflict").alias("status"))


def association_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """from_id, to_id, action: insert, delete, update (another flag) or unchanged."""
    a, b = before.withColumnRenamed("is_primary", "_b"), after.withColumnRenamed("is_primary", "_a")
    rows = a.join(b, ["from_id", "to_id"], "full")
    return rows.select("from_id", "to_id", F.when(F.col("_b").isNull(), "insert").when(F.col("_a").isNull(), "delete").when(F.col("_a") != F.col("_b"), "update").otherwise("unchanged").alias("action"))


def best_contact(contacts: DataFrame, rank: Column) -> DataFrame:
    """org, contact, rank: the first contact of each organisation by title, then id."""
    rows = contacts.withColumn("rank", rank)
    best = rows.groupBy("org").agg(F.min(F.struct("rank", "contact")).alias("b"))
    return best.select("org", "b.contact", "b.rank")


def classes(rows: DataFrame, rules: list[tuple[str, Column]], default: str) -> DataFrame:
    """class, n: rows by the first rule that holds."""
    out = None
    for name, hit in rules:
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return rows.groupBy(out.otherwise(default).alias("class")).agg(F.count("*").alias("n"))


def filter_signature(props: Column, without: list[str]) -> Column:
    """SHA-256 of an object's entries in order of their names, some left out."""
    entries = F.from_json(props, "map<string,string>")
    kept = F.array_sort(F.map_entries(F.map_filter(entries, lambda k, v: ~k.isin(*without))))
    return F.sha2(F.array_join(F.transform(kept, lambda e: F.concat_ws("=", e["key"], e["value"])), "&"), 256)


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """How alike two names are by their matching blocks, 0.85 at least if one holds the other."""
    def one(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        ratio = difflib.SequenceMatcher(None, x, y).ratio()
        return max(ratio, 0.85) if x and y and (x in y or y in x) else ratio

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def alike(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """_l, _r, similarity of the names (block, name) that meet in a block and are alike enough; each pair of names is compared once, whatever blocks it meets in.

    Two names share at most as many characters as the shorter one has, so pairs whose lengths alone keep them below `least`
    don't leave the JVM; the others are compared in Arrow batches.
    """
    pairs = left.select("block", F.col("name").alias("_l")).distinct().join(right.select("block", F.col("name").alias("_r")).distinct(), "block").select("_l", "_r").distinct()
    short, long = F.least(F.length("_l"), F.length("_r")), F.greatest(F.length("_l"), F.length("_r"))
    pairs = pairs.filter((2 * short >= least * (short + long)) | F.contains("_l", F.col("_r")) | F.contains("_r", F.col("_l")))
    return pairs.withColumn("similarity", name_similarity("_l", "_r")).filter(F.col("similarity") >= least)


def accept_names(left: DataFrame, right: DataFrame, block: str, least: float = 0.55) -> DataFrame:
    """left_id, right_id, similarity of names in the same block that are alike enough. Blocks are the caller's bound on the pairs; name_links has them by classes of copies."""
    a, b = left.withColumnRenamed(block, "block"), right.withColumnRenamed(block, "block")
    met = a.select("block", F.col("id").alias("left_id"), F.col("name").alias("_l")).join(alike(a, b, least), "_l")
    return met.join(b.select("block", F.col("id").alias("right_id"), F.col("name").alias("_r")), ["block", "_r"]).select("left_id", "right_id", "similarity")


def name_links(left: DataFrame, right: DataFrame, least: float = 0.55) -> DataFrame:
    """kind, a, b, similarity, links of the same pairs without expanding copies: rows of one side with the same block and name are a class, named by their least id.

    A row `left` or `right` for each row of that side: its id, its class and the number of rows that it is linked with. A row
    `pair` for each pair of linked classes: the left one, the right one, their similarity, and the pairs of rows that it stands for.
    """
    classes = lambda df, side: df.groupBy("block", F.col("name").alias(f"_{side}")).agg(F.min("id").alias(f"_{side}_class"), F.count("*").alias(f"_{side}_rows"))
    a, b = classes(left, "l"), classes(right, "r")
    pairs = staged(a.join(alike(left, right, least), "_l").join(b, ["block", "_r"]).select("block", "_l", "_r", "_l_class", "_r_class", "_l_rows", "_r_rows", "similarity"), "name-pairs")

    def members(df: DataFrame, kind: str, own: DataFrame, side: str, other: str) -> DataFrame:
        links = pairs.groupBy(F.col(f"_{side}_class").alias("_c")).agg(F.sum(f"_{other}_rows").alias("links"))
        named = own.join(links, own[f"_{side}_class"] == links["_c"], "left").select(F.col("block").alias("_b"), F.col(f"_{side}").alias("_n"), F.col(f"_{side}_class").alias("b"), F.coalesce("links", F.lit(0)).alias("links"))
        met = df.join(named, df["block"].eqNullSafe(named["_b"]) & df["name"].eqNullSafe(named["_n"]))
        return met.select(F.lit(kind).alias("kind"), F.col("id").alias("a"), "b", F.lit(None).cast("double").alias("similarity"), "links")

    found = pairs.select(F.lit("pair").alias("kind"), F.col("_l_class").alias("a"), F.col("_r_class").alias("b"), "similarity", (F.col("_l_rows") * F.col("_r_rows")).alias("links"))
    return members(left, "left", a, "l", "r").unionByName(members(right, "right", b, "r", "l")).unionByName(found)
