"""Sharding by a k-d tree: split at distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import common

#: A coordinate has CODE_BITS that the metadata give and TIE_BITS of a hash, TIE_ROUND of which a round looks at.
CODE_BITS, TIE_BITS, TIE_ROUND = 16, 24, 12
DIMENSIONS = ("source", "lang", "length", "doc_id")


@dataclass
class Node:
    """Part of the tree: a leaf, or the coordinate of a dimension below which rows go left."""

    number: int
    leaves: int
    first: int
    dimension: str | None = None
    cut: int = 0
    children: list[Node] = field(default_factory=list)

    def leaf(self, of: str) -> Column:
        """What `of` (number or first) is at the leaf where a row ends."""
        if not self.children:
            return F.lit(getattr(self, of))
        left, right = (c.leaf(of) for c in self.children)
        return F.when(F.col(self.dimension) < F.lit(self.cut), left).otherwise(right)


def coordinates(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, tie and a coordinate for each of DIMENSIONS.

    Source and language count by their hash, which keeps equal ones together; length by its leading bits; doc_id by its place
    between the least and the largest, whatever 64-bit integers these are. Null counts as 0. Below the metadata's bits a
    coordinate has bits of a hash of doc_id, text and the row's place in its file, so that a cut can part rows that share
    their metadata, also rows that are the same.
    """
    top = (1 << CODE_BITS) - 1
    placed = common.with_locator(docs, "doc_id", "text", "source", "lang")
    text = placed["text"].cast("binary")
    rows = placed.select(
        placed["doc_id"].cast("long").alias("doc_id"), placed["source"].alias("_source"), placed["lang"].alias("_lang"),
        (F.coalesce(F.octet_length(placed["text"]), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
        F.xxhash64("_row", F.substring_index("_file", "/", -1)).alias("_place"),
    )
    rows = common.staged(rows, "shard-rows")
    ends = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, span = float(ends["lo"] or 0), max(1.0, float((ends["hi"] or 0) - (ends["lo"] or 0)))
    bits = F.length(F.bin("size")) - 1
    codes = {
        "source": F.when(F.col("_source").isNotNull(), F.pmod(F.xxhash64("_source"), F.lit(top)) + 1),
        "lang": F.when(F.col("_lang").isNotNull(), F.pmod(F.xxhash64("_lang"), F.lit(top)) + 1),
        "length": bits * 1024 + F.expr("(size * 1024) >> (length(bin(size)) - 1)") % 1024,
        "doc_id": F.floor((F.col("doc_id").cast("double") - F.lit(lo)) / F.lit(span) * top),
    }
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size", "_place"), 64 - TIE_BITS))
    return rows.select("doc_id", "size", "text_crc32", "tie", *[(F.coalesce(c.cast("long"), F.lit(0)) * (1 << TIE_BITS) + F.col("tie")).alias(f"_{name}") for name, c in codes.items()])


def _cuts(rows: DataFrame, split: dict[int, tuple[str, float]]) -> dict[int, int]:
    """For each node of (column of its dimension, weight that should go left) the coordinate at which that weight is best met.

    Three rounds narrow it down: by the metadata's bits, then twice by TIE_ROUND bits of the hash. In a round each node's
    rows inside its present range are summed by bucket (partial sums first; at most 2^CODE_BITS buckets a node), and the
    bucket is found where the running sum passes the weight that is looked for. Only that one row a node comes to the driver.
    """
    at = {n: (0, 0.0) for n in split}  # start of the range, weight before it
    spark = rows.sparkSession
    for width in (TIE_BITS, TIE_BITS - TIE_ROUND, 0):
        outer = {TIE_BITS: CODE_BITS + TIE_BITS, TIE_BITS - TIE_ROUND: TIE_BITS, 0: TIE_ROUND}[width]
        values = ", ".join(f"({n}, {DIMENSIONS.index(split[n][0][1:])}, {at[n][0]}L, {split[n][1] - at[n][1]!r}D)" for n in split)
        ranges = spark.sql(f"SELECT * FROM VALUES {values} AS ranges(n, dimension, start, goal)")  # a row a node
        inside = rows.join(F.broadcast(ranges), rows["node"] == ranges["n"]).withColumn("at", F.get(F.array(*[f"_{d}" for d in DIMENSIONS]), F.col("dimension")))
        inside = inside.filter((F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + (1 << outer)))
        sums = inside.groupBy("node", "goal", F.shiftright("at", width).alias("bucket")).agg(F.sum("size").alias("weight"))
        upto = F.sum("weight").over(Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        sums = sums.withColumn("before", upto - F.col("weight"))
        passed = sums.filter(F.col("before") <= F.col("goal")).groupBy("node").agg(F.max_by(F.struct("bucket", "before", "weight"), "bucket").alias("b"))
        for r in passed.collect():
            n, b = r["node"], r["b"]
            at[n] = (b["bucket"] << width, at[n][1] + b["before"])
            if width == 0 and split[n][1] - at[n][1] > b["weight"] / 2:  # nearer with the bucket's rows
                at[n] = (at[n][0] + 1, at[n][1])
    return {n: start for n, (start, _) in at.items()}


def kd_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, tie, shard of every row of docs; the shards' bytes are nearly equal.

    The tree starts with all rows in one node that is to have `shards` leaves. On each level every node of two or more is cut
    along the dimension of DIMENSIONS in which its rows are widest against all rows (the first of equal ones), at the
    weighted median, or, with an odd number of leaves, where each side gets its leaves' share of the bytes; so all leaves
    reach their target, all bytes / shards, at once. All nodes of a level are cut by the same few jobs, each of which sums
    bytes over the narrow staged rows; the driver holds one row a node, `shards` at most. Rows that share all metadata are
    parted by a hash, so a hot source or a large group of copies spreads evenly. Size is the UTF-8 bytes of the text (null:
    none) and 16. A null text is an empty one; rows that repeat are dealt one by one; an empty table gives no rows; a text
    longer than a shard's share makes its shard larger by that much. Columns besides doc_id, text, source and lang are not read.
    """
    rows = coordinates(docs)
    columns = [f"_{d}" for d in DIMENSIONS]
    root = Node(0, shards, 0)
    nodes, whole, count = [root], None, 1
    while nodes := [n for n in nodes if n.leaves > 1]:
        placed = rows.withColumn("node", root.leaf("number"))
        wanted = placed.filter(F.col("node").isin([n.number for n in nodes]))
        seen = wanted.groupBy("node").agg(F.sum("size").alias("weight"), *[(F.max(F.shiftright(c, TIE_BITS)) - F.min(F.shiftright(c, TIE_BITS))).alias(c) for c in columns]).collect()
        seen = {r["node"]: r for r in seen}
        whole = whole or seen.get(0)
        split = {}
        for n in nodes:
            if n.number in seen:
                wide = [seen[n.number][c] / max(1, whole[c]) for c in columns]
                split[n.number] = (columns[wide.index(max(wide))], seen[n.number]["weight"] * (n.leaves // 2) / n.leaves)
        cuts = _cuts(placed, split) if split else {}
        below = []
        for n in nodes:
            n.dimension, n.cut = split.get(n.number, (columns[0], 0))[0], cuts.get(n.number, 0)
            left = n.leaves // 2
            n.children = [Node(count, left, n.first), Node(count + 1, n.leaves - left, n.first + left)]
            count += 2
            below += n.children
        nodes = below
    return rows.select("doc_id", "size", "text_crc32", "tie", root.leaf("first").alias("shard"))


def with_slots(rows: DataFrame) -> DataFrame:
    """rows with `slot`, their place in their shard, gapless from 0, by hash and doc_id; a shard spreads over many buckets."""
    buckets = common.bucket_count(rows.count())
    rows = rows.withColumn("bucket", F.shiftright(F.col("tie") * buckets, TIE_BITS))
    return common.bucketed_sums(rows, ["shard"], ["bucket"], ["tie", "doc_id", "text_crc32"], F.lit(1), "slot")


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slots(kd_shards(common.documents(spark, sf_dir)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
