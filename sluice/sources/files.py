"""Readers of raw objects, histories, messy files and sheets; writers of daily facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions import norm

RAW = "account string, object_type string, id string, properties map<string,string>, associations map<string,array<struct<id:string,types:array<struct<typeId:int,label:string>>>>>, history map<string,array<struct<value:string,timestamp:string,sourceType:string>>>, archived boolean, createdAt string, updatedAt string"
#: The type id of a primary association.
PRIMARY_TYPE = 5


def read_raw_objects(spark: SparkSession, path: str) -> DataFrame:
    """Payloads of a CRM export, JSON lines: as RAW, with created_at, updated_at, fetched_at (when its file was written) and the SHA-256 of their properties, whatever their order."""
    rows = spark.read.schema(RAW).json(path).withColumn("fetched_at", F.col("_metadata.file_modification_time"))
    entries = F.array_sort(F.map_entries("properties"))
    rows = rows.withColumns({"created_at": norm.utc_timestamp(F.col("createdAt")), "updated_at": norm.utc_timestamp(F.col("updatedAt")), "payload_sha256": F.sha2(F.to_json(entries), 256)})
    return rows.drop("createdAt", "updatedAt")


def explode_history(objects: DataFrame, property_: str) -> DataFrame:
    """account, id, value, at, source_type, seq: a property's values, oldest first; of equal times those further down the newest-first list come first."""
    rows = objects.select("account", "id", F.posexplode(F.try_element_at("history", F.lit(property_))).alias("pos", "h"))
    rows = rows.withColumn("at", F.try_to_timestamp("h.timestamp")).filter("at IS NOT NULL")
    seq = F.row_number().over(Window.partitionBy("account", "id").orderBy("at", F.col("pos").desc()))
    return rows.select("account", "id", F.col("h.value").alias("value"), "at", F.col("h.sourceType").alias("source_type"), seq.alias("seq"))


def explode_associations(objects: DataFrame) -> DataFrame:
    """account, id, to_type, to_id, label, is_primary: primary is a sole association of a type, or one with the type id or the label that means it; label is the first there is."""
    rows = objects.select("account", "id", F.explode("associations").alias("to_type", "links"))
    rows = rows.select("account", "id", "to_type", F.size("links").alias("n"), F.explode("links").alias("l"))
    said = F.coalesce(F.exists("l.types", lambda t: (t["typeId"] == PRIMARY_TYPE) | (t["label"] == "Primary")), F.lit(False))
    label = F.get(F.filter(F.transform("l.types", lambda t: t["label"]), lambda x: x.isNotNull()), F.lit(0))
    return rows.select("account", "id", "to_type", F.col("l.id").alias("to_id"), label.alias("label"), ((F.col("n") == 1) | said).alias("is_primary"))


def file_catalog(spark: SparkSession, path: str, roles: list[tuple[str, str]]) -> DataFrame:
    """path, role, length, sha256, canonical: of equal files the one of the first role, no copy by its name, and the least path."""
    rows = spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
    rank = F.lit(len(roles))
    for i, (_, pattern) in reversed(list(enumerate(roles))):
        rank = F.when(F.col("path").rlike(pattern), i).otherwise(rank)
    copy = F.col("path").rlike(r"(?i)(copy|\(\d+\))")
    place = F.row_number().over(Window.partitionBy("sha256").orderBy(rank, copy, "path"))
    role = F.element_at(F.array(*[F.lit(r) for r, _ in roles], F.lit("other")), rank + 1)
    return rows.select("path", role.alias("role"), "length", "sha256", (place == 1).alias("canonical"))


def sheet_rows(rows: DataFrame) -> DataFrame:
    """tab, row_number, cells, cells_json, text_flat, row_sha: cells trimmed, trailing blanks off, empty rows out; text_flat has the filled cells with blanks between."""
    trimmed = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    last = F.array_max(F.transform(trimmed, lambda c, i: F.when(c != "", i + 1).otherwise(0)))
    cut = rows.withColumn("cells", F.slice(trimmed, 1, F.coalesce(last, F.lit(0)))).filter(F.size("cells") > 0)
    flat = F.array_join(F.filter("cells", lambda c: c != ""), " ")
    return cut.withColumns({"cells_json": F.to_json("cells"), "text_flat": flat, "row_sha": F.sha2(F.to_json("cells"), 256)})


def tab_shas(rows: DataFrame) -> DataFrame:
    """tab, rows, tab_sha: a hash of a tab's rows with their numbers, whatever their order in the files; sums of parts of row hashes, so no tab is gathered."""
    h = F.sha2(F.concat_ws(":", F.col("row_number").cast("string"), "row_sha"), 256)
    parts = [F.sum(F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(4)]
    return rows.groupBy("tab").agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(":", *parts), 256).alias("tab_sha"))


def write_days(df: DataFrame, path: str, day: str = "ist_day") -> None:
    """Writes df by day; the days in it replace what was there for them, others stay, so a rerun changes nothing."""
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def tidy(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys, metric, value: one row for each value."""
    return df.unpivot(keys, values, "metric", "value")


def write_tidy(df: DataFrame, keys: list[str], values: list[str], path: str) -> None:
    """Writes tidy rows as CSV with a header, a file for each task."""
    tidy(df, keys, values).write.mode("overwrite").option("header", True).csv(path)


def to_sorted_json(df: DataFrame) -> DataFrame:
    """json: each row as an object with its names in order."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("json"))
