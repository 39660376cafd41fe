"""Tables between the steps of an operator: written to the shared folder, read again, and deleted when nobody reads them any more."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows that may be broadcast.
BROADCAST_BYTES = 32 << 20

_own_folders: dict[str, str] = {}
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where that is unset a session on one machine gets a temporary folder; a cluster's executors couldn't see it, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", None)
        if master and not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and the executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="spark-shared-")
        folder = _own_folders[app]
    return folder.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The list of tables that are staged inside; they are deleted at the end, but for those staged with keep, which the scratch around it, if any, deletes."""
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield paths
    finally:
        _scratch.reset(token)
        for path in paths:
            delete(spark, path)


def scratch_path(spark: SparkSession, label: str, *, keep: bool = False) -> str:
    """A path in the shared folder that is deleted like a staged table: a store, or a stream's files and checkpoint."""
    return _noted(shared_path(spark, label), keep)


def _noted(path: str, keep: bool) -> str:
    open_ = _scratch.get()[: -1 if keep else None]
    if open_:
        open_[-1].append(path)
    return path


def tidy(label: str, query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """query with its scratch: if it stages tables its result is staged too, which is all that it leaves; else the result is as it was."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch(spark) as paths:
            result = query(spark, sf_dir)
            return staged(result, label, keep=True) if paths else result

    return run


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, label: str, *, keep: bool = False, path: str | None = None) -> DataFrame:
    """df written to the shared folder and read again: the lineage ends there, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = _noted(path or shared_path(spark, label), keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> int:
    """What the rows take when they are broadcast, by a sum over them: 8 bytes a field and some for the row, and what texts and lists hold."""
    width = 32 + 8 * len(df.columns)
    sizes = [F.octet_length(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType | T.BinaryType)]
    sizes += [F.size(f"`{f.name}`") * 64 for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    sizes += [F.lit(64) for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
    total = F.lit(width)
    for s in sizes:
        total = total + F.greatest(F.coalesce(s, F.lit(0)), F.lit(0))
    return df.agg(F.sum(total.cast("long"))).first()[0] or 0


def bounded_broadcast(df: DataFrame, most: int | None = None) -> DataFrame:
    """df, a staged table, with the hint to broadcast it if its rows take at most `most` bytes; else Spark joins it by a shuffle."""
    return F.broadcast(df) if row_bytes(df) <= (BROADCAST_BYTES if most is None else most) else df.hint("merge")
