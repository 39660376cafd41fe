"""Readers of JSON records, mail, snapshots and lookup keys, and what a second read of the same things changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.functions.staging import staged

#: Names under which documents keep their list of records, the first there is.
LISTS = ("records", "results", "data", "items", "rows")
HEADERS = "array<struct<name:string,value:string>>"


def json_records(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, position, record (JSON) of the records in JSON documents: the document itself if it is a list, else its first list of LISTS that holds objects; texts that are no JSON have none."""
    doc = F.try_parse_json(text)
    lists = [F.try_variant_get(doc, f"$.{name}", "array<variant>") for name in LISTS]
    whole = F.try_variant_get(doc, "$", "array<variant>")
    rows = docs.select(key, F.posexplode(F.coalesce(whole, *lists)).alias("position", "v"))
    return rows.select(key, "position", F.to_json("v").alias("record")).filter(F.startswith(F.col("record"), F.lit("{")))


def _header_of(name: str, headers: str = "headers") -> Column:
    """The first header of a name, in any case."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"]


def mail_parts(raw: DataFrame) -> DataFrame:
    """id, path, mime, filename, attachment_id, size, headers, data of every part of the messages in JSON, however deep they nest; in the order of `path` a tree is read from the top down.

    Each round takes the parts of the parts before it, so there are as many rounds as the deepest message has levels; texts that are no JSON, or have no id, have none.
    """
    doc = F.try_parse_json("json")
    of = lambda path, kind: F.try_variant_get("part", f"$.{path}", kind)
    level = staged(raw.select(doc.alias("part")).select(of("id", "string").alias("id"), F.lit("").alias("path"), of("payload", "variant").alias("part")).filter("id IS NOT NULL AND part IS NOT NULL"), "mail-level")
    found = []
    while not level.isEmpty():
        names = {"mime": F.lower(F.coalesce(of("mimeType", "string"), F.lit(""))), "filename": F.coalesce(of("filename", "string"), F.lit("")), "attachment_id": of("body.attachmentId", "string"), "size": of("body.size", "bigint"), "headers": of("headers", HEADERS), "data": of("body.data", "string")}
        found.append(level.select("id", "path", *[c.alias(n) for n, c in names.items()]))
        below = level.select("id", "path", F.posexplode(of("parts", "array<variant>")).alias("_i", "_part"))
        level = staged(below.select("id", F.concat_ws(".", F.nullif("path", F.lit("")), F.format_string("%06d", "_i")).alias("path"), F.col("_part").alias("part")), "mail-level")
    schema = f"id string, path string, mime string, filename string, attachment_id string, size long, headers {HEADERS}, data string"
    return reduce(DataFrame.unionByName, found) if found else raw.sparkSession.createDataFrame([], schema)


def _is_file() -> Column:
    """Parts with a name or a place of their own, but for the containers of others."""
    container = F.startswith("mime", F.lit("multipart/")) | ((F.col("mime") == "message/rfc822") & F.col("attachment_id").isNull())
    return ~container & (F.col("attachment_id").isNotNull() | (F.col("filename") != ""))


def mail_attachments(parts: DataFrame) -> DataFrame:
    """id, path, filename, mime, size, content_id, disposition, a row for each attachment of mail_parts; inline if it says so, or if it has a content id and neither a disposition nor a name."""
    said = F.lower(F.trim(F.coalesce(_header_of("Content-Disposition"), F.lit(""))))
    content = F.nullif(F.regexp_replace(F.trim(_header_of("Content-ID")), "^<+|>+$", ""), F.lit(""))
    inline = said.startswith("inline") | ((said == "") & content.isNotNull() & (F.col("filename") == ""))
    return parts.filter(_is_file()).select("id", "path", "filename", "mime", "size", content.alias("content_id"), F.when(inline, "inline").otherwise("attachment").alias("disposition"))


def mail_messages(raw: DataFrame, parts: DataFrame) -> DataFrame:
    """id, thread, at, subject, sender, recipients (to, cc and bcc, joined), body, is_sent, is_unread, attachments (how many that aren't inline) of messages in JSON and their mail_parts.

    body is all plain parts in order, else the text of all HTML parts; a part's bytes are read as its charset, Latin or UTF-8.
    """
    latin = F.coalesce(_header_of("Content-Type"), F.lit("")).rlike(r"(?i)charset\s*=\s*\"?(iso-8859-1|latin-?1|windows-1252|us-ascii)\b")
    octets = F.unbase64(F.translate("data", "-_", "+/"))
    text = F.when(latin, F.decode(octets, "ISO-8859-1")).otherwise(F.make_valid_utf8(octets.cast("string")))
    texts = parts.filter(~_is_file() & F.col("data").isNotNull() & F.col("mime").isin("text/plain", "text/html")).select("id", F.struct("path", text.alias("text")).alias("t"), (F.col("mime") == "text/plain").alias("plain"))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, F.col("t")))), lambda t: t["text"]), "\n")
    bodies = texts.groupBy(F.col("id").alias("_b")).agg(F.bool_or("plain").alias("_plain"), F.trim(joined(F.col("plain")), F.lit(" \t\r\n")).alias("_text"), html_lines(joined(~F.col("plain"))).alias("_html"))
    files = mail_attachments(parts).groupBy(F.col("id").alias("_f")).agg(F.count_if(F.col("disposition") == "attachment").alias("_files"))
    of = lambda path, kind: F.try_variant_get("m", f"$.{path}", kind)
    rows = raw.select(F.try_parse_json("json").alias("m")).select(of("id", "string").alias("id"), F.coalesce(of("threadId", "string"), of("id", "string")).alias("thread"), F.timestamp_millis(of("internalDate", "bigint")).alias("at"), F.coalesce(of("labelIds", "array<string>"), F.array()).alias("labels"), of("payload.headers", HEADERS).alias("headers")).filter("id IS NOT NULL")
    rows = rows.join(bodies, rows["id"] == bodies["_b"], "left").join(files, rows["id"] == files["_f"], "left")
    emails = lambda name: F.coalesce(F.regexp_extract_all(F.lower(_header_of(name)), F.lit(r"[^<>\s,;:\"()]+@[^<>\s,;:\"()]+"), 0), F.array())
    label = lambda name: F.array_contains("labels", name)
    return rows.select(
        "id", "thread", "at", _header_of("Subject").alias("subject"), norm.email(F.get(emails("From"), F.lit(0))).alias("sender"), F.array_join(F.concat(emails("To"), emails("Cc"), emails("Bcc")), ",").alias("recipients"),
        F.when(F.col("_plain"), F.col("_text")).otherwise(F.col("_html")).alias("body"), label("SENT").alias("is_sent"), label("UNREAD").alias("is_unread"), F.coalesce("_files", F.lit(0)).alias("attachments"),
    )


def html_lines(html: Column) -> Column:
    """The text of HTML with block elements on lines of their own, tags and blanks at the ends off, named characters decoded, empty lines out."""
    from sluice.functions.text import ENTITIES

    s = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    s = F.regexp_replace(s, r"(?i)<\s*/?\s*(p|div|br|li|tr|h[1-4]|ul|ol)(\s[^>]*)?/?\s*>", "\n")
    s = F.regexp_replace(s, "<[^>]*>", "")
    for name, char in ENTITIES.items():
        s = F.replace(s, F.lit(name), F.lit(char))
    lines = F.filter(F.transform(F.split(s, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\x0b\f\r]+", " "))), lambda x: x != "")
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def snapshots(docs: DataFrame, name: str, text: str) -> DataFrame:
    """name, day, day_from, mismatch, metric, label, value of metric snapshots in JSON {day, metrics: {metric: {label: number}}}: the day of the payload, else of the file's name; mismatch where both are there and differ."""
    j = F.from_json(text, "struct<day:string,metrics:map<string,map<string,double>>>")
    rows = docs.select(name, j.alias("j")).withColumns({"_own": F.col("j.day").try_cast("date"), "_named": F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")})
    rows = rows.withColumns({"day": F.coalesce("_own", "_named"), "day_from": F.when(F.col("_own").isNotNull(), "payload").when(F.col("_named").isNotNull(), "name"), "mismatch": F.coalesce(F.col("_own") != F.col("_named"), F.lit(False))})
    return rows.select(name, "day", "day_from", "mismatch", F.explode("j.metrics").alias("metric", "v")).select(name, "day", "day_from", "mismatch", "metric", F.explode("v").alias("label", "value"))


def lookup_keys(cells: DataFrame, key: str, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """key, kind, value: the first valid token of each kind (pattern of headers, rule) over a row's cells (map of header to text), headers in order, cells of several values split at commas, semicolons, bars and blanks."""
    entries = F.array_sort(F.map_entries("cells"))
    found = []
    for kind, (pattern, rule) in kinds.items():
        own = F.filter(entries, _header(pattern))
        tokens = F.flatten(F.transform(own, lambda e: F.split(e["value"], r"[,;|\s]+")))
        valid = F.filter(F.transform(tokens, norm.RULES[rule]), lambda t: t.isNotNull())
        found.append(F.struct(F.lit(kind).alias("kind"), F.get(valid, F.lit(0)).alias("value")))
    return cells.select(key, F.explode(F.array(*found)).alias("f")).select(key, "f.*").filter("value IS NOT NULL")


def _header(pattern: str):
    return lambda e: F.lower(e["key"]).rlike(pattern)


def label_deltas(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """message, labels after changes (message, seq, added, removed) are applied in order: a label is there if its last change added it, or if it was there and none took it off."""
    was = state.select("message", F.explode("labels").alias("label"), F.lit(-1).cast("long").alias("seq"), F.lit(True).alias("on"))
    change = lambda c, on: deltas.select("message", F.explode(c).alias("label"), "seq", F.lit(on).alias("on"))
    last = was.unionByName(change("added", True)).unionByName(change("removed", False)).groupBy("message", "label").agg(F.max_by("on", F.struct("seq", "on")).alias("on"))
    after = last.groupBy("message").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("on"), F.col("label")))), ",").alias("labels"))
    return state.select("message").unionByName(deltas.select("message")).distinct().join(after, "message", "left").select("message", F.coalesce("labels", F.lit("")).alias("labels"))


def dirty(objects: DataFrame, projected: DataFrame, key: list[str]) -> DataFrame:
    """objects whose payload isn't the one that was projected last, or never was: what has to be projected again. projected: key, sha."""
    p = projected.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("sha").alias("_sha"))
    met = objects.join(p, [objects[k] == p[f"_{k}"] for k in key], "left")
    return met.filter(~F.col("sha").eqNullSafe(F.col("_sha"))).select(*objects.columns)


def revisions(versions: DataFrame, key: list[str], order: str) -> DataFrame:
    """versions with revision, from 1, and is_current: payloads of a key in order, those equal to the one before them left out."""
    w = Window.partitionBy(*key).orderBy(order)
    kept = versions.withColumn("_before", F.lag("sha").over(w)).filter(~F.col("sha").eqNullSafe(F.col("_before"))).drop("_before")
    back = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return kept.withColumns({"revision": F.row_number().over(w), "is_current": F.row_number().over(back) == 1})
