"""Tables kept by key in hash buckets: a batch rewrites the buckets that it touches, and a manifest says which files count."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.staging import delete, scratch, staged


@dataclass(frozen=True)
class KeyedTable:
    """A row for each key at `path`, in `buckets` buckets by the key's hash, as many as make a bucket one task's work.

    Each batch has a number. Its buckets go to data/<number>/, the rows that it replaced to revisions/<number>, what became of
    its rows to actions/<number>; then manifests/<number>, put in place by a rename, says for every bucket which batch wrote it
    last. Readers see the table as one manifest has it, so they never see half a batch; a batch that failed is written
    anew, and one that has its manifest is done and changes nothing when it comes again. Nulls in keys are values.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _files(self):
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self, before: int | None = None) -> dict:
        """The last manifest, or the last one before a batch: schema, and by bucket the batch that wrote it."""
        folder, files = self._files()
        names = sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []
        names = [n for n in names if n.isdigit() and (before is None or int(n) < before)]
        if not names:
            return {"schema": None, "written": {}}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{names[-1]}", wholetext=True).first()[0])

    def _put_manifest(self, number: int, manifest: dict) -> None:
        folder, files = self._files()
        path = lambda name: self.spark._jvm.org.apache.hadoop.fs.Path(folder, name)
        out = files.create(path(f"_{number:012d}"), True)
        out.write(json.dumps(manifest).encode())
        out.close()
        files.rename(path(f"_{number:012d}"), path(f"{number:012d}"))

    def _rows(self, manifest: dict, only: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/data/{n:012d}/bucket={b}" for b, n in manifest["written"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The rows as of the last manifest, or the last one before a batch's number; None if there is none."""
        manifest = self._manifest(before)
        return self._rows(manifest) if manifest["schema"] else None

    def merge(self, batch: DataFrame, number: int, *, version: str | None = None, compare: list[str] | None = None) -> None:
        """Takes in a batch: new keys are inserted, others updated where a column of `compare` differs (all but key and version if none is named).

        With `version` the newest row of a key counts, the batch's among equal ones; an older row than the table's is stale and
        left out. Without it a batch has one row a key. Only the buckets that the batch touches are read and written.
        """
        folder, files = self._files()
        if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")):
            return
        manifest = self._manifest(number)
        keys, columns = list(self.keys), batch.columns
        compare = compare or [c for c in columns if c not in (*keys, version)]
        if version:
            batch = batch.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(version)).alias("_r")).select("_r.*")
        with scratch(self.spark):
            rows = staged(batch.withColumn("_bucket", self.bucket()), "merge-rows")
            touched = {r[0] for r in rows.select("_bucket").distinct().collect()}  # self.buckets at most
            old = self._rows(manifest, touched) if manifest["schema"] else self.spark.createDataFrame([], batch.schema)
            met = lambda a, b: [a[k].eqNullSafe(b[f"_{k}"]) for k in keys]
            values = F.struct(*compare)
            was = old.select(*[F.col(k).alias(f"_{k}") for k in keys], values.alias("_was"), *([F.col(version).alias("_version")] if version else []), F.lit(True).alias("_old"))
            stale = F.col("_version") > F.col(version) if version else F.lit(False)
            action = F.when(F.col("_old").isNull(), "inserted").when(values.eqNullSafe(F.col("_was")), "unchanged").when(stale, "stale").otherwise("updated")
            fate = staged(rows.join(was, met(rows, was), "left").select(*columns, action.alias("_action")), "merge-fates")
            changed = fate.filter("_action IN ('inserted', 'updated')")
            of = changed.select(*[F.col(k).alias(f"_{k}") for k in keys], "_action")
            after = old.join(of, met(old, of), "left_anti").select(*columns).unionByName(changed.select(*columns))
            rewritten = {r[0] for r in changed.select(self.bucket()).distinct().collect()}  # self.buckets at most
            after = after.withColumn("bucket", self.bucket()).filter(F.col("bucket").isin(*rewritten) if rewritten else F.lit(False))
            after.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{number:012d}")
            old.join(of.filter("_action = 'updated'"), met(old, of), "left_semi").write.mode("overwrite").parquet(f"{self.path}/revisions/{number:012d}")
            fate.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/actions/{number:012d}")
        written = manifest["written"] | {str(b): number for b in rewritten}
        self._put_manifest(number, {"schema": manifest["schema"] or json.loads(batch.select(*columns).schema.json()), "written": written})

    def of_batches(self, what: str) -> DataFrame:
        """actions or revisions of all batches, with the batch's number."""
        rows = self.spark.read.parquet(f"{self.path}/{what}/*")
        number = F.regexp_extract(F.col("_metadata.file_path"), rf"/{what}/(\d+)/", 1).cast("int")
        return rows.withColumn("batch", number)

    def vacuum(self) -> None:
        """Deletes the buckets that the last manifest doesn't name; readers of earlier ones must be through."""
        manifest, kept = self._manifest(), set()
        kept = {f"{n:012d}/bucket={b}" for b, n in manifest["written"].items()}
        _, files = self._files()
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        for batch in files.listStatus(top):
            for part in files.listStatus(batch.getPath()):
                name = f"{batch.getPath().getName()}/{part.getPath().getName()}"
                if "bucket=" in name and name not in kept:
                    delete(self.spark, f"{self.path}/data/{name}")
