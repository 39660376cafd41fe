"""Queries of readers, writers, streams and incremental steps: files are derived by Spark from the given tables, written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.patterns import ist_day
from sluice.functions.staging import scratch_path, staged
from sluice.plans.model import derived, duck, table
from sluice.sources import delimited, files, records
from sluice.sources.store import KeyedTable
from sluice.streaming import events as st

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = duck(sql)
        return f

    return add


def written(df: DataFrame, label: str, kind: str = "json", **options) -> str:
    """The folder of df's files."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).format(kind).save(path)
    return path


def objects(spark: SparkSession, d: str) -> DataFrame:
    """A CRM object for each order: properties, a history of three stages newest first, and its line items as associations."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("lines"))
    o = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    entry = lambda v, t: F.struct(F.lit(v).alias("value"), t.alias("timestamp"), F.lit("UI").alias("sourceType"))
    history = F.array(entry("third", F.lit("2024-01-03T00:00:00Z")), entry("second", F.when(k % 3 > 0, "2024-01-01T00:00:00Z")), entry("first", F.lit("2024-01-01T00:00:00Z")))
    links = F.transform(F.coalesce("lines", F.array().cast("array<int>")), lambda x: F.struct(s(x).alias("id"), F.when(x == 2, F.array(F.struct(F.lit(9).alias("typeId"), F.lit(None).cast("string").alias("label")), F.struct(F.lit(10).alias("typeId"), F.lit("Primary").alias("label")))).when(x == 3, F.array(F.struct(F.lit(5).alias("typeId"), F.lit("Main").alias("label")))).alias("types")))
    props = F.create_map(F.lit("status"), "o_orderstatus", F.lit("owner"), s(F.col("o_custkey") % 7))
    rows = o.select(F.concat(F.lit("p"), s(k % 2)).alias("account"), F.lit("deal").alias("object_type"), s(k).alias("id"), props.alias("properties"), F.create_map(F.lit("line"), links).alias("associations"), F.create_map(F.lit("stage"), history).alias("history"), (k % 11 == 0).alias("archived"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T01:02:03.456Z")).alias("createdAt"), F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("updatedAt"))
    return files.read_raw_objects(spark, written(rows, "objects"))


O = "o AS (SELECT *, 'p' || (o_orderkey % 2) AS account, CAST(o_orderkey AS VARCHAR) AS id FROM orders)"


@query("raw_objects", f"WITH {O} SELECT account, 'deal' AS object_type, id, o_orderstatus AS status, CAST(o_custkey % 7 AS VARCHAR) AS owner, o_orderkey % 11 = 0 AS archived, epoch_ms(o_orderdate) + 3723456 AS created_ms, CASE WHEN o_orderkey % 2 = 0 THEN epoch_ms(o_orderdate) END AS updated_ms, true AS fetched FROM o")
def _(spark, d):
    return objects(spark, d).select("account", "object_type", "id", F.col("properties")["status"].alias("status"), F.col("properties")["owner"].alias("owner"), "archived", F.unix_millis("created_at").alias("created_ms"), F.unix_millis("updated_at").alias("updated_ms"), F.col("fetched_at").isNotNull().alias("fetched"))


@query("raw_payload_groups", f"WITH {O} SELECT count(*) AS objects, count(DISTINCT o_orderstatus || o_custkey % 7) AS payloads FROM o")
def _(spark, d):
    return objects(spark, d).agg(F.count("*").alias("objects"), F.countDistinct("payload_sha256").alias("payloads"))


@query("property_history", f"WITH {O}, h AS (SELECT account, id, 'first' AS value, 1 AS seq FROM o UNION ALL SELECT account, id, 'second', 2 FROM o WHERE o_orderkey % 3 > 0 UNION ALL SELECT account, id, 'third', CASE WHEN o_orderkey % 3 > 0 THEN 3 ELSE 2 END FROM o) SELECT * FROM h")
def _(spark, d):
    return files.explode_history(objects(spark, d), "stage").select("account", "id", "value", "seq")


@query("object_associations", f"WITH {O}, l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), n AS (SELECT l_orderkey, count(*) AS n FROM l GROUP BY 1) SELECT account, id, 'line' AS to_type, CAST(l_linenumber AS VARCHAR) AS to_id, CASE l_linenumber WHEN 2 THEN 'Primary' WHEN 3 THEN 'Main' END AS label, n = 1 OR l_linenumber IN (2, 3) AS is_primary FROM o JOIN l ON l.l_orderkey = o_orderkey JOIN n ON n.l_orderkey = o_orderkey")
def _(spark, d):
    return files.explode_associations(objects(spark, d)).select("account", "id", "to_type", "to_id", "label", "is_primary")


@query("messy_rows", "SELECT CAST(s_suppkey AS VARCHAR) AS key, CASE WHEN s_suppkey % 3 = 0 THEN s_name || chr(10) || ';\"x' ELSE s_name END AS name, CAST(s_nationkey AS VARCHAR) AS extra FROM supplier")
def _(spark, d):
    s = table(spark, d, "supplier")
    line = F.concat_ws(";", F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit('"'), "s_name", F.lit('\n;""x"'))).otherwise(F.col("s_name")), F.col("s_nationkey").cast("string"), F.lit(""))
    lines = s.groupBy((F.col("s_suppkey") % 4).alias("f")).agg(F.array_sort(F.collect_list(line)).alias("l"))
    head = F.array(F.lit("Report of suppliers;"), F.lit(""), F.lit("key;name;name;"))
    path = scratch_path(spark, "messy")
    lines.select("f", F.array_join(F.concat(head, "l"), "\n").alias("value")).write.partitionBy("f").text(path)
    rows = delimited.read_delimited(spark, f"{path}/*/*.txt")
    cell = lambda n: F.try_element_at("cells", F.lit(n))
    return rows.select(cell("key").alias("key"), cell("name").alias("name"), cell("name__2").alias("extra"))


@query("file_catalog", "SELECT CASE WHEN f = 0 THEN 'first' ELSE 'other' END AS role, count(*) AS files, count(*) FILTER (k) AS canonical FROM (SELECT DISTINCT r_regionkey % 2 AS f, r_regionkey, r_regionkey < 2 AS k FROM region) GROUP BY 1")
def _(spark, d):
    r = table(spark, d, "region")
    rows = r.select((F.col("r_regionkey") % 2).alias("f"), F.col("r_regionkey").alias("copy"), F.concat(F.lit("body "), (F.col("r_regionkey") % 2).cast("string")).alias("value"))
    path = scratch_path(spark, "catalog")
    rows.repartition("copy").write.partitionBy("f", "copy").text(path)
    catalog = files.file_catalog(spark, f"{path}/*/*/*.txt", [("first", "f=0")])
    return catalog.groupBy("role").agg(F.count("*").alias("files"), F.count_if("canonical").alias("canonical"))


@query("json_records", "SELECT o_custkey AS doc, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS position, '{{\"id\":' || o_orderkey || '}}' AS record FROM orders")
def _(spark, d):
    lists = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("doc")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("id")))).alias("r"))
    body = F.when(F.col("doc") % 3 == 0, F.to_json("r")).when(F.col("doc") % 3 == 1, F.to_json(F.struct(F.lit(1).alias("n"), F.col("r").alias("results")))).otherwise(F.to_json(F.struct(F.col("r").alias("items"))))
    bad = spark.sql("SELECT -1L AS doc, 'no json' AS body")
    return records.json_records(lists.select("doc", body.alias("body")).unionByName(bad), "doc", "body")


@query("sheet_tabs", "SELECT tab, rows, md5(flat) AS flat FROM (SELECT s_nationkey AS tab, count(*) AS rows, string_agg(s_suppkey || ' ' || s_name, '|' ORDER BY s_suppkey) AS flat FROM supplier GROUP BY s_nationkey)")
def _(spark, d):
    cells = F.array(F.col("s_suppkey").cast("string"), F.concat(F.lit(" "), "s_name", F.lit(" ")), F.lit(" "), F.lit(""))
    s = table(spark, d, "supplier")
    raw = s.select(F.col("s_nationkey").alias("tab"), F.col("s_suppkey").alias("row_number"), cells.alias("cells")).unionByName(s.select(F.col("s_nationkey").alias("tab"), (-F.col("s_suppkey") - 1).alias("row_number"), F.array(F.lit(""), F.lit(" ")).alias("cells")))
    rows = files.sheet_rows(raw)
    return rows.groupBy("tab").agg(F.count("*").alias("rows"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_number", "text_flat"))), lambda r: r["text_flat"]), "|")).alias("flat"))


@query("sheet_fingerprints", "SELECT count(DISTINCT s_nationkey) AS tabs, count(DISTINCT s_nationkey) AS shas FROM supplier")
def _(spark, d):
    s = table(spark, d, "supplier")
    rows = files.sheet_rows(s.select(F.col("s_nationkey").alias("tab"), F.col("s_suppkey").alias("row_number"), F.array(F.col("s_name"), F.lit("")).alias("cells")))
    shas = files.tab_shas(rows)
    return shas.agg(F.count("*").alias("tabs"), F.countDistinct("tab_sha").alias("shas"))


def _mail(spark, d) -> DataFrame:
    """A message for each turn: an alternative of a plain part (two of three turns) and an HTML one, within a mixed part with files; every fifth one forwards another message with a file of its own."""
    c = table(spark, d, "conversations")
    t, s = F.col("turn"), lambda x: x.cast("string")
    body = lambda x: F.struct(F.translate(F.regexp_replace(F.base64(F.encode(x, "UTF-8")), r"[=\r\n]", ""), "+/", "-_").alias("data"))
    header = lambda *pairs: F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs])
    js = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    list_ = lambda *parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    tree = lambda kind, parts: F.concat(F.lit(f'{{"mimeType":"{kind}","parts":'), parts, F.lit("}"))
    plain = F.when(t % 3 > 0, js(mimeType=F.lit("text/plain"), body=body(F.concat(F.lit("plain é "), s(t)))))
    html = js(mimeType=F.lit("text/html"), body=body(F.lit("<style>p{}</style><div>line  one</div><p>two &amp; <b>three</b></p>")))
    file = F.when(t % 4 == 0, js(mimeType=F.lit("application/pdf"), filename=F.lit("f.pdf"), body=F.struct(F.lit("x1").alias("attachmentId"), F.lit(12).alias("size"))))
    image = F.when(t % 2 == 1, js(mimeType=F.lit("image/png"), headers=header(("content-id", F.lit("<c1>"))), body=F.struct(F.lit("x2").alias("attachmentId"), F.lit(3).alias("size"))))
    deep = F.when(t % 5 == 0, tree("message/rfc822", list_(tree("multipart/mixed", list_(js(mimeType=F.lit("Text/Plain"), headers=header(("Content-Type", F.lit("text/plain; charset=UTF-8"))), body=body(F.lit("forwarded"))), js(mimeType=F.lit("text/csv"), filename=F.lit("deep.csv"), headers=header(("Content-Disposition", F.lit("Inline; x"))), body=F.struct(F.lit("x3").alias("attachmentId"), F.lit(7).alias("size"))))))))
    head = js(headers=header(("Subject", F.col("role")), ("FROM", F.when(t % 2 == 0, F.concat(F.lit("A <A"), s(F.col("conv_id")), F.lit("@x.example>"))).otherwise("nobody")), ("To", F.lit('"B, C" <b@y.example>, c@y.example')), ("Cc", F.when(t % 2 == 0, "D@y.example"))))
    payload = F.concat(F.regexp_replace(head, "\\}$", ""), F.lit(',"mimeType":"multipart/mixed","parts":'), list_(tree("multipart/alternative", list_(plain, html)), file, image, deep), F.lit("}"))
    labels = F.array_compact(F.array(F.when(F.col("role") == "assistant", F.lit("SENT")), F.when(t == 0, F.lit("UNREAD"))))
    top = js(id=F.concat_ws(":", s(F.col("conv_id")), s(t)), threadId=s(F.col("conv_id")), internalDate=s(t * 60000), labelIds=labels)
    return c.select(F.concat(F.regexp_replace(top, "\\}$", ""), F.lit(',"payload":'), payload, F.lit("}")).alias("json"))


@query("mail_messages", "SELECT conv_id || ':' || turn AS id, CAST(conv_id AS VARCHAR) AS thread, turn * 60 AS at_s, role AS subject, CASE WHEN turn % 2 = 0 THEN 'a' || conv_id || '@x.example' END AS sender, 'b@y.example,c@y.example' || CASE WHEN turn % 2 = 0 THEN ',d@y.example' ELSE '' END AS recipients, md5(CASE WHEN turn % 3 > 0 AND turn % 5 = 0 THEN 'plain é ' || turn || chr(10) || 'forwarded' WHEN turn % 3 > 0 THEN 'plain é ' || turn WHEN turn % 5 = 0 THEN 'forwarded' ELSE 'line one' || chr(10) || 'two & three' END) AS body, role = 'assistant' AS is_sent, turn = 0 AS is_unread, CAST(turn % 4 = 0 AS BIGINT) AS attachments FROM conversations")
def _(spark, d):
    raw = staged(_mail(spark, d), "mail")
    return records.mail_messages(raw, records.mail_parts(raw)).select("id", "thread", F.unix_seconds("at").alias("at_s"), "subject", "sender", "recipients", F.md5("body").alias("body"), "is_sent", "is_unread", "attachments")


@query("mail_attachments", "SELECT conv_id || ':' || turn AS id, unnest(list_filter([CASE WHEN turn % 4 = 0 THEN 'f.pdf|application/pdf|12||attachment' END, CASE WHEN turn % 2 = 1 THEN '|image/png|3|c1|inline' END, CASE WHEN turn % 5 = 0 THEN 'deep.csv|text/csv|7||inline' END], lambda x: x IS NOT NULL)) AS file FROM conversations")
def _(spark, d):
    parts = records.mail_parts(_mail(spark, d))
    return records.mail_attachments(parts).select("id", F.concat_ws("|", "filename", "mime", F.col("size").cast("string"), F.coalesce("content_id", F.lit("")), "disposition").alias("file"))


@query("metric_snapshots", "SELECT CASE o_custkey % 4 WHEN 0 THEN 'x' ELSE 'snap_2024-01-0' || (1 + o_custkey % 9) END || '_' || o_custkey AS name, CASE WHEN o_custkey % 3 = 0 THEN DATE '2024-01-05' WHEN o_custkey % 4 > 0 THEN DATE '2024-01-01' + CAST(o_custkey % 9 AS INT) END AS day, CASE WHEN o_custkey % 3 = 0 THEN 'payload' WHEN o_custkey % 4 > 0 THEN 'name' END AS day_from, o_custkey % 3 = 0 AND o_custkey % 4 > 0 AND o_custkey % 9 <> 4 AS mismatch, 'flow' AS metric, o_orderstatus AS label, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY o_custkey, o_orderstatus")
def _(spark, d):
    k = F.col("o_custkey")
    n = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").cast("double").alias("n")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m"))
    name = F.concat_ws("_", F.when(k % 4 == 0, "x").otherwise(F.concat(F.lit("snap_2024-01-0"), (1 + k % 9).cast("string"))), k.cast("string"))
    docs = n.select(name.alias("name"), F.to_json(F.struct(F.when(k % 3 == 0, "2024-01-05").alias("day"), F.create_map(F.lit("flow"), F.col("m")).alias("metrics"))).alias("body"))
    return records.snapshots(docs, "name", "body")


KEYED = "SELECT c_custkey AS row, CASE WHEN c_custkey % 4 = 0 THEN 'none; bad host, D' || c_custkey || '.Example | e.example' ELSE 'x' END AS web, CASE WHEN c_custkey % 3 = 0 THEN 'A' || c_custkey || '@x.example,b@y.example' ELSE 'nobody' END AS mail FROM {customer}"


@query("lookup_keys", f"WITH r AS ({KEYED}) SELECT row, 'domain' AS kind, 'd' || row || '.example' AS value FROM r WHERE row % 4 = 0 UNION ALL SELECT row, 'email', 'a' || row || '@x.example' FROM r WHERE row % 3 = 0")
def _(spark, d):
    rows = derived(spark, d, KEYED).select("row", F.create_map(F.lit("Company Website"), "web", F.lit("E-Mail"), "mail", F.lit("Notes"), F.lit("z.example")).alias("cells"))
    return records.lookup_keys(rows, "row", {"domain": ("web|domain|url", "ascii_domain"), "email": ("mail", "email")})


@query("tidy_metrics", "SELECT day, section, label, metric, value FROM (SELECT CAST(o_orderdate AS DATE) AS day, 'orders' AS section, o_orderstatus AS label, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL) UNPIVOT (value FOR metric IN (n, customers))")
def _(spark, d):
    rows = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day"), F.lit("orders").alias("section"), F.col("o_orderstatus").alias("label")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))
    path = scratch_path(spark, "tidy")
    files.write_tidy(rows, ["day", "section", "label"], ["n", "customers"], path)
    return spark.read.schema("day date, section string, label string, metric string, value long").option("header", True).csv(path)


@query("sorted_json", "SELECT s_suppkey, md5('{{\"balance\":' || CASE WHEN s_suppkey % 3 = 0 THEN 'null' ELSE CAST(s_nationkey AS VARCHAR) END || ',\"name\":\"' || s_name || '\",\"s_suppkey\":' || s_suppkey || '}}') AS json FROM supplier")
def _(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("name"), "s_suppkey", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_nationkey")).alias("balance"))
    return files.to_sorted_json(rows).select(F.get_json_object("json", "$.s_suppkey").cast("long").alias("s_suppkey"), F.md5("json").alias("json"))


@query("day_overwrites", "SELECT ist_day, event_type, n * CASE WHEN day(ist_day) % 2 = 0 THEN 10 ELSE 1 END AS n FROM (SELECT CAST(ts + INTERVAL 330 MINUTE AS DATE) AS ist_day, event_type, count(*) AS n FROM events GROUP BY ALL)")
def _(spark, d):
    daily = table(spark, d, "events").groupBy(ist_day(F.col("ts")).alias("ist_day"), "event_type").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "days")
    files.write_days(daily, path)
    for _ in range(2):  # a rerun of some days replaces them and leaves the others
        files.write_days(daily.filter("dayofmonth(ist_day) % 2 = 0").withColumn("n", F.col("n") * 10), path)
    return spark.read.parquet(path).select("ist_day", "event_type", "n")


def _stream(spark: SparkSession, d: str, twice: bool = False) -> DataFrame:
    """The events as a stream, each twice if need be."""
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    path = written(e.unionByName(e) if twice else e, "stream", "parquet")
    return spark.readStream.schema(e.schema).parquet(path)


def _ended(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream has given when its input ends, with `batch`; each batch is a folder, so that a repeated one replaces itself."""
    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, "stream-out")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/{number:09d}")

    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", scratch_path(spark, "stream-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "integer")).parquet(f"{out}/*")


@query("stream_deduplicated", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    rows = _ended(st.deduplicated(_stream(spark, d, twice=True), "event_id"), "append")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_daily_entries", "SELECT CAST(ts + INTERVAL 330 MINUTE AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, d):
    rows = _ended(st.daily_entries(_stream(spark, d), ["event_type"]), "update")
    return rows.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("stream_sliding_engaged", "SELECT last_day, count(DISTINCT user_id) AS users FROM (SELECT user_id, CAST(unnest(generate_series(d, d + 6, INTERVAL 1 DAY)) AS DATE) AS last_day FROM (SELECT DISTINCT user_id, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS d FROM events)) GROUP BY last_day")
def _(spark, d):
    rows = _ended(st.sliding_engaged(_stream(spark, d), []), "append")
    return rows.groupBy("last_day").agg(F.count("*").alias("users"))


@query("stream_first_touch", "SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS first_s, count(*) AS n FROM events GROUP BY user_id")
def _(spark, d):
    rows = _ended(st.first_touch(_stream(spark, d)), "update")
    last = rows.groupBy("user_id").agg(F.max_by(F.struct("first_time", "n"), "n").alias("s"))
    return last.select("user_id", F.unix_seconds("s.first_time").alias("first_s"), F.col("s.n").alias("n"))


def _upserted(spark, d) -> KeyedTable:
    """The events of even, then of odd numbers as payloads of their users, each set a batch; every third event has the payload of the user's first."""
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.col("user_id").alias("id"), k.alias("version"), F.md5(F.when(k % 3 == 0, F.col("user_id").cast("string")).otherwise(F.concat("event_type", k.cast("string")))).alias("sha"))
    path = scratch_path(spark, "upsert-in")
    found = KeyedTable(spark, scratch_path(spark, "upserts"), ("id",), 8)
    for part in (F.col("version") % 2 == 0, F.col("version") % 2 == 1):
        e.filter(part).coalesce(1).write.mode("append").parquet(path)
        st.upsert_batches(spark.readStream.schema(e.schema).parquet(path), found, "version", f"{found.path}/checkpoint")
    return found


UPSERTS = """e AS (SELECT user_id AS id, event_id AS version, md5(CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type || event_id END) AS sha FROM events),
a AS (SELECT id, max(version) AS version, arg_max(sha, version) AS sha FROM e WHERE version % 2 = 0 GROUP BY id), b AS (SELECT id, max(version) AS version, arg_max(sha, version) AS sha FROM e WHERE version % 2 = 1 GROUP BY id),
f AS (SELECT b.*, a.sha AS was, CASE WHEN a.id IS NULL THEN 'inserted' WHEN a.sha = b.sha THEN 'unchanged' WHEN a.version > b.version THEN 'stale' ELSE 'updated' END AS action FROM b LEFT JOIN a ON a.id = b.id)"""


@query("stream_upserts", f"WITH {UPSERTS} SELECT id, version, sha FROM f WHERE action IN ('inserted', 'updated') UNION ALL SELECT id, version, sha FROM a WHERE id NOT IN (SELECT id FROM f WHERE action = 'updated')")
def _(spark, d):
    return _upserted(spark, d).read()


@query("stream_upsert_actions", f"WITH {UPSERTS} SELECT 0 AS batch, 'inserted' AS action, count(*) AS n FROM a UNION ALL SELECT 1, action, count(*) FROM f GROUP BY action")
def _(spark, d):
    return _upserted(spark, d).of_batches("actions").select("batch", "action", "n")


@query("stream_upsert_revisions", f"WITH {UPSERTS} SELECT 1 AS batch, id, was AS sha FROM f WHERE action = 'updated'")
def _(spark, d):
    return _upserted(spark, d).of_batches("revisions").select("batch", "id", "sha")


@query("dirty_objects", "SELECT o_orderkey AS id, md5(o_orderstatus) AS sha FROM orders WHERE o_orderkey % 5 < 2")
def _(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.alias("id"), F.md5("o_orderstatus").alias("sha"))
    done = rows.withColumn("sha", F.when(F.col("id") % 5 == 0, F.lit(None).cast("string")).when(F.col("id") % 5 == 1, F.lit("old")).otherwise(F.col("sha")))
    return records.dirty(rows, done, ["id"])


SCD = "a AS (SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 7 > 0), b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_name || '!' ELSE c_name END AS name FROM customer WHERE c_custkey % 5 > 0)"


def _scd(spark, d) -> KeyedTable:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    found = KeyedTable(spark, scratch_path(spark, "scd"), ("k",), 8)
    found.merge(c.filter("k % 7 > 0"), 0)
    found.merge(c.filter("k % 5 > 0").withColumn("name", F.when(F.col("k") % 3 == 0, F.concat("name", F.lit("!"))).otherwise(F.col("name"))), 1)
    return found


@query("scd1_table", f"WITH {SCD} SELECT coalesce(a.k, b.k) AS k, coalesce(b.name, a.name) AS name FROM a FULL JOIN b ON a.k = b.k")
def _(spark, d):
    return _scd(spark, d).read()


@query("scd1_actions", f"WITH {SCD} SELECT CASE WHEN a.k IS NULL THEN 'inserted' WHEN a.name = b.name THEN 'unchanged' ELSE 'updated' END AS action, count(*) AS n FROM b LEFT JOIN a ON a.k = b.k GROUP BY 1")
def _(spark, d):
    return _scd(spark, d).of_batches("actions").filter("batch = 1").select("action", "n")


@query("payload_revisions", "SELECT o_custkey AS k, o_orderkey AS version, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS revision, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1 AS is_current FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) WHERE b IS DISTINCT FROM o_orderstatus")
def _(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("sha"))
    return records.revisions(rows, ["k"], "version").select("k", "version", "revision", "is_current")


@query("label_deltas", "WITH s AS (SELECT c_custkey AS m, unnest(['INBOX', 'UNREAD']) AS l, -1::BIGINT AS q, true AS o FROM customer), x AS (SELECT o_custkey AS m, CASE o_orderkey % 3 WHEN 0 THEN 'UNREAD' WHEN 1 THEN 'STAR' ELSE 'INBOX' END AS l, o_orderkey AS q, o_orderkey % 2 = 0 AS o FROM orders), t AS (SELECT m, l, arg_max(o, q) AS o FROM (SELECT * FROM s UNION ALL SELECT * FROM x) GROUP BY ALL) SELECT m AS message, coalesce(array_to_string(list_sort(list(l) FILTER (o)), ','), '') AS labels FROM t GROUP BY m")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("message"), F.array(F.lit("INBOX"), F.lit("UNREAD")).alias("labels"))
    k = F.col("o_orderkey")
    label = F.array(F.when(k % 3 == 0, "UNREAD").when(k % 3 == 1, "STAR").otherwise("INBOX"))
    none = F.array().cast("array<string>")
    deltas = table(spark, d, "orders").select(F.col("o_custkey").alias("message"), k.alias("seq"), F.when(k % 2 == 0, label).otherwise(none).alias("added"), F.when(k % 2 == 1, label).otherwise(none).alias("removed"))
    return records.label_deltas(c, deltas)
