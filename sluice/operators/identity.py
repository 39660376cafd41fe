"""Who is who: identifiers, golden companies, survivors of merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.staging import staged

#: A key that so many entities of one source claim says little about one of them.
SHARED_BY = 3


def identifiers(entities: DataFrame, types: list[tuple[str, str]], *, confidence: dict[str, str] | None = None, generic: dict[str, tuple[str, ...]] | None = None, least: float = 0.9) -> DataFrame:
    """entity, source, type, value, priority, confidence, claims, strength from entities with a column for each (type, column), the strongest type first.

    claims counts the entities of all sources. A value is weak in a source where SHARED_BY or more entities claim it, and stays
    strong in the others; it is weak where its type's `confidence` column is below `least`, and everywhere if it is one of its
    type's `generic` values, such as hosts of free mail.
    """
    sure = lambda t: F.col(confidence[t]).cast("double") if confidence and t in confidence else F.lit(1.0)
    keys = F.array(*[F.struct(F.lit(t).alias("type"), F.col(c).alias("value"), F.lit(i).alias("priority"), sure(t).alias("confidence")) for i, (t, c) in enumerate(types)])
    rows = entities.select("entity", "source", F.explode(keys).alias("k")).select("entity", "source", "k.*").filter("value IS NOT NULL")
    same = lambda c: (rows["type"] == c["_t"]) & (rows["value"] == c["_v"])
    claims = rows.groupBy(F.col("type").alias("_t"), F.col("value").alias("_v")).agg(F.countDistinct("entity").alias("claims"))
    within = rows.groupBy(F.col("source").alias("_s"), F.col("type").alias("_t"), F.col("value").alias("_v")).agg(F.countDistinct("entity").alias("_n"))
    # every row has its claims; as a left join Spark leaves it out where nobody reads them
    rows = rows.join(claims, same(claims), "left").drop("_t", "_v").join(within, same(within) & rows["source"].eqNullSafe(within["_s"]))
    weak = (F.col("_n") >= SHARED_BY) | (F.col("confidence") < least)
    for t, values in (generic or {}).items():
        weak = weak | ((F.col("type") == t) & F.col("value").isin(*values))
    return rows.select("entity", "source", "type", "value", "priority", "confidence", "claims", F.when(weak, "weak").otherwise("strong").alias("strength"))


def strong_claims(ids: DataFrame) -> DataFrame:
    """entity, source, type, value, priority, first: the strong identifiers, each with the first entity that claims it; entities are imported in the order of their ids.

    A value's rows meet its first claimant by one join, whose large partitions Spark splits; no pairs of claimants are made.
    The strong ones are staged, since both sides of that join read them.
    """
    strong = staged(ids.filter("strength = 'strong'").select("entity", "source", "type", "value", "priority"), "strong")
    first = strong.groupBy(F.col("type").alias("_t"), F.col("value").alias("_v")).agg(F.min("entity").alias("first"))
    return strong.join(first, (strong["type"] == first["_t"]) & (strong["value"] == first["_v"])).drop("_t", "_v")


def roots(pointers: DataFrame) -> DataFrame:
    """node, root of every row (node, to) of a forest: each round a node points to where its target pointed, until all targets are roots; so a path of n takes log2(n) rounds."""
    at = staged(pointers.select("node", "to"), "roots")
    while True:
        next_ = at.select(F.col("node").alias("_n"), F.col("to").alias("_to"))
        moved = at.join(next_, at["to"] == next_["_n"], "left")
        after = staged(moved.select("node", F.coalesce("_to", "to").alias("to"), F.col("_to").isNotNull().alias("_moved")), "roots")
        at = after.select("node", "to")
        if after.filter("_moved").isEmpty():
            return at.withColumnRenamed("to", "root")


def golden(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """entity, golden, how: the company that an entity is linked to, and the type of the key that did it, or new.

    Entities come one after another. One that claims a key which an earlier one had is linked to the company that owns the key,
    of several keys by the one of the least priority number (of two values of one type, the one with the earlier claimant);
    else it begins a company. Keys that nobody owns go to its company. Companies are never merged: where two keys of an entity
    have two owners, `conflicts` tells. A key is owned by the company of its first claimant, so an entity's company is that of
    one earlier entity, and the companies are the roots of these pointers.
    """
    best = F.min(F.struct("priority", "first", "type")).alias("_best")
    to = claims.filter("first < entity").groupBy(F.col("entity").alias("node")).agg(best).select("node", F.col("_best.first").alias("to"), F.col("_best.type").alias("how"))
    to = staged(to, "golden-pointers")
    found = roots(to).withColumnRenamed("node", "_e")
    found = found.join(to.select("node", "how"), found["_e"] == F.col("node"))
    rows = entities.select("entity").join(found, entities["entity"] == found["_e"], "left")
    return rows.select("entity", F.coalesce("root", "entity").alias("golden"), F.coalesce("how", F.lit("new")).alias("how"))


def owned(claims: DataFrame, labels: DataFrame) -> DataFrame:
    """claims with golden, the entity's company, and owner, the company that has the key; where they differ the key is only weak evidence."""
    own = labels.select(F.col("entity").alias("_e"), "golden")
    owner = labels.select(F.col("entity").alias("_f"), F.col("golden").alias("owner"))
    rows = claims.join(own, claims["entity"] == own["_e"]).drop("_e")
    return rows.join(owner, rows["first"] == owner["_f"]).drop("_f")


def conflicts(claims: DataFrame, labels: DataFrame) -> DataFrame:
    """left, right, types, score: pairs of golden companies, left less than right, that an entity of the one has a strong key of the other; for a person to decide, never merged."""
    met = owned(claims, labels).filter("golden <> owner")
    pairs = met.groupBy(F.least("golden", "owner").alias("left"), F.greatest("golden", "owner").alias("right")).agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))
    return pairs.withColumn("score", F.lit(0.9))


def name_candidates(companies: DataFrame, most: int = 6) -> DataFrame:
    """left, right, score: pairs of golden companies (golden, sources, name_key, name_norm, city, country) of a block of one name_key of at most `most`, of two sources or more together, whose countries don't differ.

    0.60 for the block, 0.15 for equal names, 0.10 for the same city and 0.10 for the same country. Larger blocks are names
    that say too little; they are left out by rule.
    """
    sizes = companies.filter(F.length("name_key") >= 4).groupBy("name_key").agg(F.count("*").alias("n")).filter(F.col("n").between(2, most))
    rows = companies.join(sizes, "name_key")
    side = lambda x: rows.select("name_key", *[F.col(c).alias(f"{c}_{x}") for c in ("golden", "sources", "name_norm", "city", "country")])
    pairs = side("a").join(side("b"), "name_key").filter("golden_a < golden_b AND size(array_union(sources_a, sources_b)) >= 2 AND (country_a IS NULL OR country_b IS NULL OR country_a = country_b)")
    same = lambda x, y, points: F.when(x == y, points).otherwise(0)
    points = 60 + same(F.col("name_norm_a"), F.col("name_norm_b"), 15) + same(F.lower("city_a"), F.lower("city_b"), 10) + same(F.col("country_a"), F.col("country_b"), 10)
    return pairs.select(F.col("golden_a").alias("left"), F.col("golden_b").alias("right"), (F.least(F.lit(95), points) / 100.0).alias("score"))


def survivors(pointers: DataFrame) -> DataFrame:
    """entity, survivor after merge pointers (entity, merged_into), followed to their end by doubling, however long; on a cycle the least of it.

    A round's rows are staged, since the next one reads them twice. A round in which no entity comes to its end or meets a
    lesser one is the last: none would later, since each entity on the way to one that would comes to it earlier.
    """
    to = F.coalesce("merged_into", "entity")
    at = staged(pointers.select("entity", to.alias("to"), F.least("entity", to).alias("least"), F.col("merged_into").isNull().alias("end")), "survivors")
    while True:
        next_ = at.select(F.col("entity").alias("_n"), F.col("to").alias("_to"), F.col("least").alias("_least"), F.col("end").alias("_end"))
        to, least, end = F.coalesce("_to", "to"), F.least("least", F.coalesce("_least", "least")), F.col("end") | F.coalesce("_end", F.lit(False))
        moved = at.join(next_, at["to"] == next_["_n"], "left")
        after = staged(moved.select("entity", to.alias("to"), least.alias("least"), end.alias("end"), ((end != F.col("end")) | (least != F.col("least"))).alias("_moved")), "survivors")
        at = after.select("entity", "to", "least", "end")
        if after.filter("_moved").isEmpty():
            return at.select("entity", F.when(F.col("end"), F.col("to")).otherwise(F.col("least")).alias("survivor"))


def identifier_survivors(ids: DataFrame, survived: DataFrame) -> DataFrame:
    """ids with survivor, the company that a claimant's merge pointers end at, and on_tombstone, whether that is another one."""
    s = survived.select(F.col("entity").alias("_e"), "survivor")
    return ids.join(s, ids["entity"] == s["_e"], "left").drop("_e").withColumn("on_tombstone", ~F.col("survivor").eqNullSafe(F.col("entity")))


def pointer_problems(pointers: DataFrame, labels: DataFrame) -> DataFrame:
    """entity, problem: merge pointers (entity, merged_into) that can't stand: own_identity, missing_target, same_golden (labels say they are one already) or cycle."""
    known = labels.select(F.col("entity").alias("_t"), F.col("golden").alias("_tg"))
    own = labels.select(F.col("entity").alias("_e"), F.col("golden").alias("_eg"))
    rows = pointers.filter("merged_into IS NOT NULL").join(own, F.col("entity") == own["_e"], "left").join(known, F.col("merged_into") == known["_t"], "left")
    ends = survivors(pointers)
    stuck = ends.join(pointers.filter("merged_into IS NULL").select(F.col("entity").alias("survivor")), "survivor", "left_anti").select(F.col("entity").alias("_c"), F.lit(True).alias("_cycle"))
    rows = rows.join(stuck, rows["entity"] == stuck["_c"], "left")
    problem = F.when(F.col("entity") == F.col("merged_into"), "own_identity").when(F.col("_t").isNull(), "missing_target").when(F.col("_eg") == F.col("_tg"), "same_golden").when(F.col("_cycle"), "cycle")
    return rows.select("entity", problem.alias("problem")).filter("problem IS NOT NULL")


def golden_fields(entities: DataFrame, labels: DataFrame, fields: list[str]) -> DataFrame:
    """golden, members, sources (sorted) and each field's first value that isn't null, in the order of the entities: what a company begins with stays, later members fill in."""
    rows = entities.join(labels.select(F.col("entity").alias("_e"), "golden"), F.col("entity") == F.col("_e"))
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("entity"))).alias(f) for f in fields]
    return rows.groupBy("golden").agg(F.count("*").alias("members"), F.array_sort(F.collect_set("source")).alias("sources"), *first)


def golden_keys(claims: DataFrame, labels: DataFrame, types: list[str]) -> DataFrame:
    """golden and, for each type, the first strong value that the company owns, in the order of the entities."""
    rows = owned(claims, labels).filter("golden = owner")
    first = [F.min_by("value", F.when(F.col("type") == t, F.struct("entity", "value"))).alias(t) for t in types]
    return rows.groupBy("golden").agg(*first)


def source_overlap(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """sources, companies: golden companies by the number of sources they come from."""
    n = entities.join(labels.select("entity", "golden"), "entity").groupBy("golden").agg(F.countDistinct("source").alias("sources"))
    return n.groupBy("sources").agg(F.count("*").alias("companies"))


def unique_owner(ids: DataFrame) -> DataFrame:
    """type, value, entity of values that exactly one entity claims."""
    return ids.groupBy("type", "value").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("entity")).filter("n = 1").drop("n")


def lookup(rows: DataFrame, owners: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """rows with entity and status: found by one of the keys (type, column), ambiguous if they disagree, or unlinked."""
    for t, c in keys:
        o = owners.filter(F.col("type") == t).select(F.col("value").alias(c), F.col("entity").alias(f"_{t}"))
        rows = rows.join(o, c, "left")
    hits = F.array_distinct(F.array_compact(F.array(*[F.col(f"_{t}") for t, _ in keys])))
    status = F.when(F.size(hits) == 0, "unlinked").when(F.size(hits) == 1, "linked").otherwise("ambiguous")
    return rows.withColumn("status", status).withColumn("entity", F.when(F.size(hits) == 1, F.get(hits, 0))).drop(*[f"_{t}" for t, _ in keys])
