"""Data quality: validation, reconciliation, findings and their history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with `failed`, the names of the rules they break). A rule that is null is kept."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()]))
    rows = df.withColumn("failed", broken)
    return rows.filter(F.size("failed") == 0).drop("failed"), rows.filter(F.size("failed") > 0)


def upsert_findings(before: DataFrame, now: DataFrame) -> DataFrame:
    """fingerprint, status, occurrences, action after a run: new, seen again, reopened, or resolved as it's gone."""
    b = before.select("fingerprint", F.col("status").alias("_s"), F.col("occurrences").alias("_n"))
    n = now.groupBy("fingerprint").agg(F.count("*").alias("n"))
    rows = b.join(n, "fingerprint", "full")
    found = F.col("n").isNotNull()
    action = F.when(F.col("_s").isNull(), "new").when(found & (F.col("_s") == "resolved"), "reopened").when(found, "seen").when(F.col("_s") == "open", "resolved").otherwise("unchanged")
    status = F.when(found, "open").otherwise("resolved")
    return rows.select("fingerprint", status.alias("status"), (F.coalesce("_n", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("occurrences"), action.alias("action"))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, left, right, delta of counts on both sides, those of one side only too."""
    a, b = (d.groupBy(*keys).agg(F.count("*").alias(n)) for d, n in ((left, "left"), (right, "right")))
    rows = a.join(b, keys, "full").select(*keys, F.coalesce("left", F.lit(0)).alias("left"), F.coalesce("right", F.lit(0)).alias("right"))
    return rows.withColumn("delta", F.col("right") - F.col("left"))


def set_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and side: both, left or right."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    return a.join(b, key, "full").select(key, F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right").alias("side"))


def row_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, action: insert, update, delete or unchanged, by a hash of the other columns."""
    hashed = lambda d, name: d.select(*keys, F.sha2(F.to_json(F.struct(*[c for c in sorted(d.columns) if c not in keys])), 256).alias(name))
    rows = hashed(before, "_b").join(hashed(after, "_a"), keys, "full")
    return rows.select(*keys, F.when(F.col("_b").isNull(), "insert").when(F.col("_a").isNull(), "delete").when(F.col("_a") != F.col("_b"), "update").otherwise("unchanged").alias("action"))


def orphans(tables: dict[str, DataFrame], links: list[tuple[str, str, str, str]]) -> DataFrame:
    """link, orphans: rows whose key has no row in the table it points to."""
    parts = []
    for child, column, parent, key in links:
        gone = tables[child].filter(F.col(column).isNotNull()).join(tables[parent].select(F.col(key).alias("_k")), F.col(column) == F.col("_k"), "left_anti")
        parts.append(gone.agg(F.count("*").alias("orphans")).select(F.lit(f"{child}.{column}").alias("link"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, name: str) -> DataFrame:
    """table, column, rows, filled, distinct values: one pass over all columns."""
    counts = [F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count(c).alias("filled")).alias(c) for c in df.columns]
    return df.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select(F.lit(name).alias("table"), "c.*")


def parity(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """side, rows that the other side doesn't have, each as often as it is missing."""
    both = [source.exceptAll(mirror).agg(F.count("*").alias("rows")).select(F.lit("source").alias("side"), "rows"), mirror.exceptAll(source).agg(F.count("*").alias("rows")).select(F.lit("mirror").alias("side"), "rows")]
    return both[0].unionByName(both[1])


def tally(rows: DataFrame, by: str, example: str, most: int = 3) -> DataFrame:
    """by, n, examples: a count and the least few distinct examples. Only as many as are shown are kept while aggregating by rank."""
    from pyspark.sql import Window

    first = rows.select(by, example).distinct().withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(example))).filter(F.col("r") <= most)
    shown = first.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(F.struct("r", F.col(example).cast("string").alias("e")))).getField("e"), ",").alias("examples"))
    return rows.groupBy(by).agg(F.count("*").alias("n")).join(shown, by, "left")


def fingerprint(df: DataFrame, by: str) -> DataFrame:
    """by, rows, hash of a group's rows whatever their order in the files.

    The hash is of the sums of the four parts of the rows' SHA-256, so no group is gathered, and rows that are doubled,
    dropped or exchanged between groups change it. Nulls differ from texts.
    """
    row = F.sha2(F.to_json(F.struct(*[c for c in sorted(df.columns) if c != by]), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")) for k in range(4)]
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256).alias("hash"))
