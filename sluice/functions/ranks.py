"""Ranks and prefix sums within groups of any size, which no single task has to hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.staging import staged

#: Rows that a window of `bucketed_sums` sorts together, about.
BUCKET_ROWS = 50_000


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """So many buckets that an even share of the rows in one of them stays near bucket_rows, however large the input."""
    return max(1, -(-rows // bucket_rows))


def bucketed_sums(df: DataFrame, groups: list[str], bucket: list[str], order: list, value: Column, name: str) -> DataFrame:
    """df with the sum of `value` over the rows before each row in its group, as column `name`.

    The order in a group is that of the `bucket` columns, then of the `order` columns. Only rows of one bucket of one group
    are sorted together; the buckets' totals, a row for each, are added up apart and joined back. A group of any size
    spreads over its buckets. Nulls in group, bucket and order columns sort first and are equal to each other.
    """
    keys = [*groups, *bucket]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*groups).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    before = totals.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_before"))
    rows = df.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [rows[k].eqNullSafe(before[f"_b_{k}"]) for k in keys]
    joined = rows.join(before, same, "left")
    return joined.select(*[rows[c] for c in df.columns], (F.col("_inner") + F.col("_before")).alias(name))


def placed(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """df with each row's place in its group, from 0, in the order of `order`, which has to tell rows of a group apart.

    Rows are dealt to ranges of (groups, order), which are written to the shared folder with the range's number, and ranked
    range by range (bucketed_sums); so a group of any size, or no group at all, spreads over as many tasks as there are ranges.
    """
    ranges = df.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id())
    rows = staged(ranges, "placed")
    return bucketed_sums(rows, groups, ["_part"], order, F.lit(1), name).drop("_part")
