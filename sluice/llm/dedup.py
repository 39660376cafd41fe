"""Exact dedup as a stateful stream: keyed state on disk that never expires, with the full texts compared on hits."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import graph
from sluice.llm import common

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition's store takes 4 MB and more at once
}


def normalised(text: Column) -> Column:
    """The text, empty if null, with A-Z in lower case and no other change."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def keyed_state(arrivals: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Runs a stream of (digest, doc_id, _file, _row) to its end; returns its state: digest, keep (doc_id, _file, _row), n.

    The state is in RocksDB on the executors' disks and in the folder `checkpoint`, a new one of the shared folder if none is
    given, keyed by digest, without watermark or expiry. A later call with the same folder goes on where the last one ended,
    also where that one was lost halfway: a digest met again, in this run or an earlier one, is always a hit. Of the rows of
    a digest the state keeps the largest doc_id (nulls are least), then the last place.
    """
    spark, path = arrivals.sparkSession, checkpoint or common.shared_path(arrivals.sparkSession, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        state = arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "_file", "_row")).alias("keep"), F.count("*").alias("n"))
        state.writeStream.format("noop").outputMode("update").option("checkpointLocation", path).trigger(availableNow=True).start().awaitTermination()
        stored = spark.read.format("statestore").load(path)
        values = stored.select("key.digest", "value.*").drop("partition_id")
        digest, keep, n = values.columns
        return common.staged(values.select(digest, F.col(f"`{keep}`").alias("keep"), F.col(f"`{n}`").alias("n")), "dedup-values")
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        if checkpoint is None:
            common.delete(spark, path)


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = 64, broadcast_bytes: int | None = None) -> DataFrame:
    """A row for each row of docs: _file, _row, doc_id, digest, keep_id, group_size, kept.

    Equal are texts that are identical after lower-casing A-Z; null counts as empty. Of equal rows the one with the largest
    doc_id is kept (null is least; of rows that share it, the last in the files), so exactly one row of each group is. An
    empty table gives no rows, and a text of any length is compared whole.
    Rows pass the state as digest, id and place only. Texts whose digest was met more than once are then compared in full:
    grouped by their bytes, after each task has merged its own copies, so a group of any size shuffles as a row for each
    task. The digests that were hit are broadcast if they take at most `broadcast_bytes` (staging.BROADCAST_BYTES if none
    are given); else each is dealt over `salts` tasks. A digest with two texts in it, if there ever is one, is decided by the
    texts. Other columns are not read.
    """
    spark = docs.sparkSession
    placed = common.with_locator(docs, "doc_id", "text")
    rows = placed.select(placed["doc_id"].cast("long").alias("doc_id"), "_file", "_row", normalised(placed["text"]).alias("norm"))
    hashed = rows.withColumn("digest", digest(F.col("norm")))
    path = common.shared_path(spark, "dedup-arrivals")
    arrivals = common.staged(hashed.drop("norm"), "dedup-arrivals", path=path)
    state = keyed_state(spark.readStream.schema(arrivals.schema).parquet(path))

    hits = common.staged(state.filter("n > 1").select(F.col("digest").alias("hit")), "dedup-hits")
    if common.row_bytes(hits) <= (common.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        suspects = hashed.join(F.broadcast(hits), hashed["digest"] == hits["hit"], "left_semi")
    else:  # a digest's rows are dealt over `salts` tasks
        dealt = hits.select("hit", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")).hint("merge")
        suspects = hashed.join(dealt, (hashed["digest"] == dealt["hit"]) & (F.pmod(hashed["_row"], F.lit(salts)) == dealt["salt"]), "left_semi")
    texts = suspects.groupBy("digest", "norm").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
    clashes = texts.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select(F.col("digest").alias("clash"))
    clashes = common.staged(clashes, "dedup-clashes")

    total = state.agg(F.sum("n")).first()[0] or 0
    hot = state.filter(F.col("n") * graph.hot_share(spark) > total).select(F.col("digest").alias("_hot"))
    groups = state.select(F.col("digest").alias("at"), F.struct("keep", "n").alias("group"))
    if clashes.isEmpty():
        return _decided(graph.spread_join(arrivals, "digest", groups, "at", "group", hot, "group").select("*", "group.*"))
    sure = arrivals.join(clashes, arrivals["digest"] == clashes["clash"], "left_anti")
    sure = graph.spread_join(sure, "digest", groups, "at", "group", hot, "group").select("*", "group.*")
    unsure = hashed.join(clashes, hashed["digest"] == clashes["clash"], "left_semi")
    groups = unsure.groupBy(F.col("digest").alias("at"), F.col("norm").alias("text")).agg(F.max(F.struct("doc_id", "_file", "_row")).alias("keep"), F.count("*").alias("n"))
    by_text = unsure.join(groups, (unsure["digest"] == groups["at"]) & (unsure["norm"] == groups["text"]))
    return _decided(sure).unionByName(_decided(by_text))


def _decided(rows: DataFrame) -> DataFrame:
    kept = (F.col("_file") == F.col("keep._file")) & (F.col("_row") == F.col("keep._row"))
    return rows.select("_file", "_row", "doc_id", "digest", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"))


def drop_copies(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that exact_dedup keeps, all columns.

    Of null and empty texts together one row stays, of rows that repeat one, of equal texts under several ids the largest
    id's; null ids count as least. An empty table stays empty.
    """
    docs = common.filed(docs)
    placed = common.with_locator(docs)
    with common.scratch(docs.sparkSession):
        dropped = exact_dedup(docs, **settings).filter("NOT kept").select(F.col("_file").alias("_f"), F.col("_row").alias("_r"))
        dropped = common.staged(dropped, "dedup-dropped", keep=True)
    dropped = common.bounded_broadcast(dropped)
    return placed.join(dropped, (placed["_file"] == dropped["_f"]) & (placed["_row"] == dropped["_r"]), "left_anti").select("_doc.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(common.documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
