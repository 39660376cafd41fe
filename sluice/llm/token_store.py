"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import common, tokens

SCHEMA = "part int, start_in_part long, n_tokens long, doc_id long, ids array<int>"


def _encoding(file: str, words: bool, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = tokens.encoder(file, words), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, bounds = encode(batch.column("text"), end_id)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            columns = [pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(start + bounds[:-1]), pa.array(np.diff(bounds)), batch.column("doc_id"), lists]
            yield pa.RecordBatch.from_arrays(columns, ["part", "start_in_part", "n_tokens", "doc_id", "ids"])
            start += int(bounds[-1])

    return run


def write_token_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, words: bool = True, stripe_bytes: int = 64 << 20, stride: int = 10_000) -> None:
    """Writes the ids of every whole text, and end_id after each, to ORC files at `path`, in ascending order of doc_id.

    Texts are sorted before they are encoded: text is what moves, and each sorted part streams through the encoder into its
    file. `part` numbers the parts in order. A null text has no ids but the end; a null doc_id sorts first; rows that share
    a doc_id are ordered by their text's hash. Columns besides doc_id and text are not read. `ids` is run-length encoded by
    ORC; every `stride` rows have an index entry with the least and largest doc_id and a Bloom filter of them.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(stripe_bytes), "orc.create.index": "true", "orc.row.index.stride": str(stride), "compression": "zstd"}
    with common.small_batches(docs.sparkSession):
        rows.mapInArrow(_encoding(tokenizer, words, end_id), SCHEMA).write.options(**options).orc(path)


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; a filter on doc_id skips stripes and row groups by their indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        columns = [batch.column("part"), batch.column("doc_id"), batch.column("start_in_part"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])


def describe_token_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each row, from the files alone.

    Parts are added up to their offsets, a row for each part; no task sees more than one part's documents.
    """
    store = read_token_store(spark, path)
    totals = store.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("at"), F.coalesce(F.sum("total").over(order), F.lit(0)).alias("offset"))
    rows = store.select("part", "doc_id", "start_in_part", "ids").mapInArrow(_crc, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, rows["part"] == offsets["at"]).select("doc_id", (F.col("offset") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = common.shared_path(spark, "token-store")
    write_token_store(common.documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    return describe_token_store(spark, path)
