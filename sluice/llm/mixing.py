"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import common


def _hex_number(text: Column, digits: int) -> Column:
    """The first digits of the text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float, weights: tuple[int, ...], cap: float) -> DataFrame:
    """source, source_size, target, rate from (source, source_size), a row for each source.

    Sources in code-point order, null last, take the weights in turn and share `share` times all sizes by weight, none more
    than `cap` times its own size; what is cut off goes to the others by weight, until none is above. With sources in the
    order of cap size / weight, the level at which the rest share what the capped ones leave rises as long as the next one
    is capped and falls after, so the final level is the largest of them.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1))
    rows = rows.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy(F.lit(0))
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    from_here = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(from_here))
    target = F.least(F.col("most"), F.max("level").over(everything) * F.col("weight"))
    rows = rows.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.select("source", "source_size", "target", rate.alias("rate"))


def mix(docs: DataFrame, *, share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """A row for each row of docs: _file, _row, doc_id, size, source_size, target, copies, taken.

    A document of a source is expected target / source size times. Within its source, the expected copies of the documents
    before it are summed, one offset that the seed draws for the source is added, and the document is emitted once for each
    whole number that its own expected copies step over; so no document is taken more than ceil(cap) times. Documents are in
    the order of their size's leading bits, then of a hash of doc_id: a source's words then stay near its target, since
    neighbours have like sizes. Ranks come from buckets of a source, so a source of any size spreads over many tasks.
    Size is the number of words; null and empty texts have none and are copied like others, which takes no words. Rows that
    repeat count as often as they come; an empty table gives no rows. Reruns agree. Columns besides doc_id, text and source are not read.
    """
    placed = common.with_locator(docs, "doc_id", "text", "source")
    rows = placed.select(placed["doc_id"].cast("long").alias("doc_id"), placed["source"].alias("source"), "_file", "_row", common.word_count(common.text_of(placed)).alias("size"))
    rows = common.staged(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = common.staged(source_targets(sizes, share, weights, cap), "mix-targets")

    buckets = common.bucket_count(rows.count())
    bits = F.length(F.bin("size")) - 1
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    rows = rows.withColumn("class", bits * 16 + F.expr("cast((size * 16) >> (length(bin(size)) - 1) as int)") % 16)
    rows = rows.withColumn("tie", _hex_number(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")), 15))
    rows = rows.withColumn("bucket", F.floor(F.col("tie") / F.lit(float(1 << 60) / buckets)))
    ranked = common.bucketed_sums(rows, ["key"], ["class", "bucket"], ["tie", "doc_id", "_file", "_row"], F.lit(1), "rank")

    t = targets.withColumnRenamed("source", "of").withColumn("offset", _hex_number(F.concat(F.coalesce("of", F.lit("")), F.lit(f":{seed}")), 12) / F.lit(float(1 << 48)))
    joined = ranked.join(t, ranked["source"].eqNullSafe(t["of"]))
    stepped = F.floor(F.col("offset") + F.col("rate") * (F.col("rank") + 1)) - F.floor(F.col("offset") + F.col("rate") * F.col("rank"))
    joined = joined.withColumn("copies", stepped.cast("long"))
    return joined.select("_file", "_row", "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """Each row of docs as often as `mix` takes it, all columns.

    Null and empty texts have no words and are copied at their source's rate; rows that repeat are each taken by themselves;
    a null source is a source, the last one. An empty table stays empty.
    """
    docs = common.filed(docs)
    placed = common.with_locator(docs)
    with common.scratch(docs.sparkSession):
        copies = mix(docs, **settings).filter("copies > 0").select(F.col("_file").alias("_f"), F.col("_row").alias("_r"), "copies")
        copies = common.staged(copies, "mix-copies", keep=True)
    joined = placed.join(copies, (placed["_file"] == copies["_f"]) & (placed["_row"] == copies["_r"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT AS tie FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, list_value(5, 2, 1)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source
), l AS (
  SELECT *, source_size * 2.0::DOUBLE AS most, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(source_size * 2.0::DOUBLE) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW r AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size, least(most, max(level) OVER () * weight) AS target,
         ('0x' || substr(md5(coalesce(source, '') || ':mix'), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u FROM l
), k AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY (length(bin(size)) - 1) * 16 + ((size * 16) >> (length(bin(size)) - 1)::BIGINT) % 16, tie, doc_id) AS k FROM d
)
SELECT k.doc_id, k.size, t.source_size, t.target,
       (k.size * (floor(t.u + (t.target / nullif(t.source_size, 0)) * k.k) - floor(t.u + (t.target / nullif(t.source_size, 0)) * (k.k - 1))))::BIGINT AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""
