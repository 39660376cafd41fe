"""Keyed tables, mail trees, references and rolling sets on small hard cases."""

import base64
import csv
import datetime as dt
import io
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.functions.patterns import rolling_distinct
from sluice.sources import delimited, records
from sluice.sources.store import KeyedTable


def tree(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{table.path}/data") for f in names if f.startswith("part")}


def actions(table, number):
    return {r.action: r.n for r in table.of_batches("actions").filter(F.col("batch") == number).collect()}


SCHEMA = "id long, version int, sha string"


def test_a_batch_rewrites_the_buckets_that_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 16)
    assert table.read() is None
    table.merge(spark.range(1600).selectExpr("id", "1 AS version", "concat('s', id) AS sha"), 0, version="version")
    before = tree(table)
    assert len(before) == 16 and actions(table, 0) == {"inserted": 1600}
    bucket = spark.range(1600).withColumn("b", table.bucket()).filter("b = 3").select("id")
    few = [r.id for r in bucket.limit(10).collect()]
    rows = [(few[0], 2, "new"), (few[1], 2, f"s{few[1]}"), (few[2], 0, "old"), (few[3], 2, "a"), (few[3], 3, "b")]
    table.merge(spark.createDataFrame(rows, SCHEMA), 1, version="version", compare=["sha"])
    after = tree(table)
    assert all(after[f] == t for f, t in before.items()) and {os.path.dirname(f)[-8:] for f in after.keys() - before.keys()} == {"bucket=3"}
    assert actions(table, 1) == {"updated": 2, "unchanged": 1, "stale": 1}
    got = {r.id: (r.version, r.sha) for r in table.read().collect()}
    assert len(got) == 1600 and [got[i] for i in few[:4]] == [(2, "new"), (1, f"s{few[1]}"), (1, f"s{few[2]}"), (3, "b")]
    assert sorted((r.id, r.sha) for r in table.of_batches("revisions").filter("batch = 1").collect()) == sorted((i, f"s{i}") for i in (few[0], few[3]))
    assert {r.id: r.sha for r in table.read(before=1).collect()} == {i: f"s{i}" for i in range(1600)}
    table.vacuum()
    assert len(tree(table)) == 16 and {r.id: (r.version, r.sha) for r in table.read().collect()} == got


def test_a_batch_comes_again(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ("a", "b"), 4)
    table.merge(spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "k", "z")], "a long, b string, v string"), 0)
    second = spark.createDataFrame([(1, None, "X"), (None, None, "y"), (3, "k", None)], "a long, b string, v string")
    with monkeypatch.context() as m, pytest.raises(OSError):
        def fails(*_):
            raise OSError
        m.setattr(KeyedTable, "_put_manifest", fails)
        table.merge(second, 1)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, table.read(before=1).collect()))
    for _ in range(2):
        table.merge(second, 1)
        assert {(r.a, r.b): r.v for r in table.read().collect()} == {(1, None): "X", (None, None): "y", (2, "k"): "z", (3, "k"): None}
        assert actions(table, 1) == {"updated": 1, "unchanged": 1, "inserted": 1}
    table.merge(second.limit(0), 2)
    assert table.read().count() == 4 and table.of_batches("actions").filter("batch = 2").count() == 0


@pytest.mark.parametrize("days", [1, 2, 7])
def test_rolling_sets(spark, days):
    rng = random.Random(days)
    first = dt.date(2024, 1, 1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([*range(6), None]), first + dt.timedelta(rng.choice([0, 1, 2, 5, 6, 7, 8, 13, 14, 15, 30, 40]))) for _ in range(120)] + [("a", 1, None)]
    expected = {}
    for k, e, d in rows:
        for i in range(days if e is not None and d else 0):
            expected.setdefault((k, d + dt.timedelta(i)), set()).add(e)
    got = rolling_distinct(spark.createDataFrame(rows, "k string, e int, d date"), ["k"], "e", "d", days)
    assert {(r.k, r.d): r.n for r in got.collect()} == {k: len(v) for k, v in expected.items()}


def test_references_beside_the_rfc(spark):
    rows = [("http://a", "g", "http://a/g"), ("http://a?x", "g", "http://a/g"), ("http://a/b", "..", "http://a/"), ("http://a/b/", "c/./../d/..", "http://a/b/"), ("HTTP://a/b", "HTTPS:/x/../y", "HTTPS:/y"), ("http://a/b#c", "", "http://a/b"), (None, "g", None), ("http://a/", "..a/.b/c..", "http://a/..a/.b/c..")]
    got = spark.createDataFrame(rows, "base string, ref string, want string").select("want", text.resolved(F.col("base"), F.col("ref")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_character_references(spark):
    rows = [("a&amp;b &lt;&#64;&#x40;&#X1F600;", "a&b <@@😀"), ("&amp;amp; & &; &nosuch; &#0; &#xD800; &#1114112; &#99999999;", "&amp; & &; &nosuch; &#0; &#xD800; &#1114112; &#99999999;"), ("&eacute&eacute;", "&eacuteé"), ("", ""), (None, None), ("&", "&")]
    got = spark.createDataFrame(rows, "t string, want string").select("want", text.decoded(F.col("t")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def coded(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def test_mail_of_any_depth(spark):
    part = {"mimeType": "text/plain", "body": {"data": coded("tief ü".encode("latin-1"))}, "headers": [{"name": "content-type", "value": "text/plain; charset=ISO-8859-1"}]}
    for i in range(12):
        part = {"mimeType": "multipart/mixed", "parts": [{"mimeType": "image/png", "filename": f"{i}.png", "body": {"size": i}}, part]}
    deep = {"id": "1", "threadId": "t", "internalDate": "1000", "labelIds": ["SENT"], "payload": part | {"headers": [{"name": "from", "value": "X <X@Y.Example>"}]}}
    flat = {"id": "2", "payload": {"mimeType": "text/html", "body": {"data": coded(b"<p>hi</p>\xff")}}}
    bare = {"id": "3", "payload": {"mimeType": "message/rfc822", "body": {"attachmentId": "q"}}}
    raw = spark.createDataFrame([(json.dumps(m),) for m in (deep, flat, bare, {"payload": {}}, {"id": "5"})] + [("no json",), (None,)], "json string")
    parts = records.mail_parts(raw).cache()
    found = {r.id: r for r in records.mail_messages(raw, parts).collect()}
    assert set(found) == {"1", "2", "3", "5"}
    assert (found["1"].body, found["1"].sender, found["1"].attachments, found["1"].is_sent, found["1"].thread) == ("tief ü", "x@y.example", 12, True, "t")
    assert (found["2"].body, found["2"].thread, found["5"].body) == ("hi\n\ufffd", "2", None)
    assert [r.filename for r in records.mail_attachments(parts).filter("id = '1'").orderBy("path").collect()] == [f"{i}.png" for i in reversed(range(12))]
    assert [(r.disposition, r.mime) for r in records.mail_attachments(parts).filter("id = '3'").collect()] == [("attachment", "message/rfc822")]
    assert records.mail_parts(raw.filter("json = 'none'")).count() == 0


def parsed_whole(data):
    """(row number, cells) of a delimited file by the csv module, header rows and all."""
    for encoding in ("utf-8-sig", "cp1252", "latin-1"):
        try:
            text = data.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    plain = re.sub('"[^"]*"?', "", text.split("\n", 1)[0])
    delimiter = max(",;\t|", key=lambda d: (plain.count(d), d == ","))
    records = [[c.strip() or None for c in r] for r in csv.reader(io.StringIO(text, newline="\n"), delimiter=delimiter)]
    filled = [i for i, r in enumerate(records) if any(r)][:8]
    if not filled:
        return []
    top = next((i for i in filled if sum(c is not None for c in records[i]) > 1), filled[0])
    head = records[top]
    while head[-1] is None:
        head = head[:-1]
    own = [c for c in head if c is not None]
    numbers = len(own) > 1 and all(re.fullmatch(r"[\d.,+-]+", c) for c in own)
    base = [f"col_{i + 1}" if c is None or numbers else c for i, c in enumerate(head)]
    names = [c if c not in base[:i] else f"{c}__{base[: i + 1].count(c)}" for i, c in enumerate(base)]
    early = [i for i in filled if i > top or (numbers and i == top)]
    data = [(n, records[i]) for n, i in enumerate(early, 1)] + [(len(early) + n, r) for n, r in enumerate(records[filled[-1] + 1 :], 1)]
    cells = lambda r: {names[i] if i < len(names) else f"col_{i + 1}": c for i, c in enumerate(r) if c is not None}
    return [(n, cells(r)) for n, r in data if any(r)]


@pytest.mark.parametrize("split", ["64", "10000000"])
def test_delimited_files_are_read_as_if_whole(spark, tmp_path, split):
    rng = random.Random(7)

    def cell(d):
        quoted = '"' + "".join(rng.choices(["a", d, '""', "\n", "x", " "], k=rng.randint(0, 6))) + '"'
        return rng.choice(["".join(rng.choices("abé12 ", k=rng.randint(0, 5))), quoted, quoted, 'q"u', '"ab"tail', str(rng.randint(0, 99))])

    files = {"empty": b"", "blank": b"\n\n ; \n", "open": b'a,b\n1,"x\ny,z\n', "latin": b"a;\x81\nb;c\n", "same": b"col_2,x,x__2,x\n1,2,3,4,5,6\n"}
    for i in range(7):
        d, end = rng.choice(",;\t|"), rng.choice(["\n", "\r\n"])
        rows = [d.join(cell(d) for _ in range(rng.randint(1, 5))) if rng.random() > 0.15 else "" for _ in range(rng.randint(1, 25))]
        top = rng.choice([[], ["Title"], ["", "Title", ""], [f"name{d}name{d}{d}z"], [f"1{d}2"]])
        files[f"f{i}"] = end.join([*top, *rows]).encode(rng.choice(["utf-8", "utf-8-sig", "cp1252"]))
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = delimited.read_delimited(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r.path), []).append((r.row_number, r.cells))
    assert {n: sorted(got.get(n, []), key=lambda x: x[0]) for n in files} == {n: parsed_whole(d) for n, d in files.items()}


def test_occupancy_goes_on_from_a_checkpoint(spark, tmp_path):
    from sluice.operators import occupancy

    rng = random.Random(1)
    rows = [(rng.randint(0, 30), i, i, rng.choice(["A", "DEAD", "WON"]), None, dt.date(2024, 1, 5) + dt.timedelta(rng.randint(0, 100))) for i in range(600)]
    rows = [(d, i, int(day.strftime("%j")), r, x, day) for d, i, _, r, x, day in rows]
    schema = "deal_id long, event_id long, entered_at long, rung string, reason string, ist_day date"
    spark.createDataFrame(rows, schema).write.partitionBy("ist_day").parquet(str(tmp_path / "events"))
    events, path = spark.read.schema(schema).parquet(str(tmp_path / "events")), str(tmp_path / "states")
    assert occupancy.write_checkpoints(events, path, "2024-02-28") == ["2024-01-31"]
    assert occupancy.write_checkpoints(events, path, "2024-03-31") == ["2024-02-29", "2024-03-31"]
    assert occupancy.write_checkpoints(events, path, "2024-03-31") == []
    assert occupancy.write_checkpoints(events, path, "2024-03-31", again_from="2024-02-10") == ["2024-02-29", "2024-03-31"]
    for d in ("2024-01-04", "2024-01-20", "2024-02-29", "2024-03-12", "2024-04-10"):
        whole = occupancy.last_events(events.filter(f"ist_day <= DATE '{d}'"))
        states = occupancy.states_at(events, path, d)
        assert sorted(map(tuple, states.collect())) == sorted(map(tuple, whole.collect()))
    plan = occupancy.states_at(events, path, "2024-03-12")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ist_day[^\]]*2024-02-29|PartitionFilters: \[[^\]]*ist_day[^\]]*19782", plan)
