"""What the operators share: words, places of rows in their files, and the library's staged tables and ranks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.ranks import BUCKET_ROWS, bucket_count, bucketed_sums
from sluice.functions.staging import BROADCAST_BYTES, bounded_broadcast, delete, row_bytes, scratch, shared_folder, shared_path, staged

__all__ = ["BROADCAST_BYTES", "BUCKET_ROWS", "bounded_broadcast", "bucket_count", "bucketed_sums", "delete", "row_bytes", "scratch", "shared_folder", "shared_path", "staged"]

#: Characters that part words: space, and tab to carriage return.
BLANKS = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANKS}]+")).cast("long")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Inside, Arrow batches have at most so many rows: a document is thousands of times a usual row, and a batch is held in full on both sides.

    The size is read when a frame with Python in it is planned, so such a frame has to be run, or staged, inside.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if not 0 < int(before or "10000") <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def filed(docs: DataFrame) -> DataFrame:
    """docs if it is read from files straight away; else a staged copy, whose rows have places that stay the same for every later read."""
    from pyspark.errors import AnalysisException

    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
        return docs
    except AnalysisException:
        return staged(docs, "rows")


def with_locator(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns of docs, or all of them in a struct `_doc` if none is named, with `_file` and `_row`, the place of each row in its files.

    Columns of docs that are called like those an operator adds so don't meet them.
    """
    docs = filed(docs)
    place = docs.metadataColumn("_metadata")
    own = [docs[f"`{c}`"] for c in columns or docs.columns]
    return docs.select(*(own if columns else [F.struct(*own).alias("_doc")]), place["file_path"].alias("_file"), place["row_index"].alias("_row"))
