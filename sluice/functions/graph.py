"""Joins on keys that may be hot, and connected components by least labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

from sluice.functions.staging import staged

#: A key is hot if it has more than 1/HOT_LEAST of the rows, or more than a shuffle task's share of them if there are more tasks.
HOT_LEAST = 128
#: Keys that an expression looks up.
LOOKED_UP = 128


def hot_share(spark: SparkSession) -> int:
    """How many shares the rows are cut into: a key with more than one is hot, so there are fewer hot keys than that."""
    return max(HOT_LEAST, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """_hot: the keys with more than a share (hot_share) of the rows, counted with partial sums."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    bound = counts.agg((F.sum("_n") / F.lit(hot_share(rows.sparkSession))).alias("_least"))
    return counts.join(F.broadcast(bound)).filter(F.col("_n") > F.col("_least")).select(F.col(key).alias("_hot"))


def _literal(value, of: DataType) -> Column:
    if isinstance(of, StructType) and value is not None:
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in of.fields])
    return F.lit(value).cast(of)


def _looked_up(rows: DataFrame, key: str, found: list, schema: StructType) -> DataFrame:
    """rows with _is, whether their key is one of those found, and _known, its value: by an expression for up to LOOKED_UP keys, else by a broadcast of them."""
    if len(found) > LOOKED_UP:
        known = F.broadcast(rows.sparkSession.createDataFrame(found, schema).select(F.col("_at").alias("_key"), F.col("_value").alias("_known"), F.lit(True).alias("_is")))
        return rows.join(known, rows[key] == known["_key"], "left").select(*[rows[c] for c in rows.columns], F.coalesce("_is", F.lit(False)).alias("_is"), "_known")
    key_type, of = schema["_at"].dataType, schema["_value"].dataType
    known = F.create_map(*[x for r in found for x in (_literal(r["_at"], key_type), _literal(r["_value"], of))]).cast(MapType(key_type, of))
    return rows.select("*", F.coalesce(F.map_contains_key(known, F.col(key)), F.lit(False)).alias("_is"), F.try_element_at(known, F.col(key)).alias("_known"))


def spread_join(rows: DataFrame, key: str, table: DataFrame, at: str, value: str, hot: DataFrame, name: str) -> DataFrame:
    """rows with `name`, the `value` of the row of `table` whose `at` is their key, null if there is none; `at` is unique.

    The values of hot keys, fewer than hot_share, are looked up once and given to every task; the rest meet by a shuffle, in
    which rows of hot keys are dealt by all their columns. So what a task gets beyond its even part is at most a share of the rows.
    """
    t = table.select(F.col(at).alias("_at"), F.col(value).alias("_value"))
    found = t.join(F.broadcast(hot), t["_at"] == hot["_hot"]).select("_at", "_value").collect()  # fewer than hot_share
    marked = _looked_up(rows, key, found, t.schema)
    marked = marked.withColumn("_deal", F.when(F.col("_is"), F.xxhash64(*rows.columns)).otherwise(F.xxhash64(key)))
    t = t.select("_at", "_value", F.xxhash64("_at").alias("_place"))
    met = marked.join(t, (marked["_deal"] == t["_place"]) & (marked[key] == t["_at"]), "left")
    return met.select(*[marked[c] for c in rows.columns], F.when(F.col("_is"), F.col("_known")).otherwise(F.col("_value")).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node that an edge (a, b) touches; label is the least node of its component.

    Each round takes the least label among a node's neighbours (partial minima first, so a hub costs a row for each task),
    then the label of that label, which halves what is left of a long path. A round's labels are staged; the rounds end when
    no label changes, which is certain, since labels only fall. Neither a hub nor the label of a giant component brings its
    rows to one task (spread_join).
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    both = staged(both, "components-edges")
    hubs = staged(hot_keys(both, "b"), "components-hubs")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "components-labels")
    while True:
        met = spread_join(both, "b", labels, "node", "label", hubs, "_label")
        near = met.groupBy("a").agg(F.min("_label").alias("near"))
        least = labels.join(near, labels["node"] == near["a"], "left")
        least = staged(least.select("node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("now")), "components-near")
        after = spread_join(least, "now", least, "node", "now", hot_keys(least, "now"), "then")
        after = staged(after.select("node", "was", F.least("now", F.coalesce("then", "now")).alias("label")), "components-labels")
        if after.filter("was <> label").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")

