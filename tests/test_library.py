"""Normalisers, readers, writers and streams on small hard cases."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.functions.patterns import asof_join, change, rolling_distinct, take_by_demand
from sluice.operators import identity, metrics, quality, report
from sluice.sources import delimited, files
from sluice.streaming import events as st

CASES = {
    "domain": [("https://WWW.Acme.com/path?x", "acme.com"), (' "acme.co.in." ', "acme.co.in"), ("user:pw@acme.com:8080", "acme.com"), ("not a host", None), ("a..b.com", None), ("acme", None), (None, None), ("", None)],
    "email": [(" A@B.com ", "a@b.com"), ("a@b", None), ("a b@c.de", None)],
    "company_name": [("  Acme   UNIT ", "acme unit"), ("  ", None)],
    "name_key": [("Zeta Labs Pvt. Ltd.", "zeta labs"), ("The Co", None), ("Café Ñandú Inc", "cafe nandu"), ("Zeta and Sons Incorporated", "zeta sons")],
    "linkedin_company": [("https://in.x.com/company/Blue-Sky-%C2%AE/?trk=x", "company/blue-sky-®"), ("x.com/in/someone", None), ("SCHOOL/abc", "school/abc"), ("x/company/", None)],
    "linkedin_person": [("https://www.x.com/in/Some-One/", "in/some-one"), ("https://x.com/company/a", None)],
    "object_id": [("0123", "123"), ("0", "0"), ("12a", None)],
    "cin": [("u12345 mh2020ptc123456", "U12345MH2020PTC123456"), ("short", None)],
    "llpin": [("aae-7433", "AAE-7433"), ("AAE7433", None)],
    "country": [("India", "IN"), ("uk", "GB"), ("de", "DE"), ("Nowhere", None)],
    "phone_e164": [("+91 98765 43210", "+919876543210"), ("0091 98765 43210", "+919876543210"), ("09876543210", "+919876543210"), ("9000000001", "+919000000001"), ("12345", None), ("none", None)],
    "utc_timestamp": [("2024-01-02", dt.datetime(2024, 1, 2)), ("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05.678Z", dt.datetime(2024, 1, 2, 3, 4, 5, 678000)), ("2024-01-02T03:04:05+05:30", dt.datetime(2024, 1, 1, 21, 34, 5)), ("1704164645", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01", None), ("soon", None)],
    "finite": [("1.5", 1.5), ("NaN", None), ("x", None), ("Infinity", None)],
    "slug": [(" Cold Call / 2 ", "cold_call_2"), ("--", None)],
}


@pytest.mark.parametrize("rule", CASES)
def test_normalisers(rule, spark):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES[rule])], "i int, raw string")
    got = {r.i: r.v for r in rows.select("i", norm.RULES[rule](F.col("raw")).alias("v")).collect()}
    assert [got[i] for i in range(len(got))] == [want for _, want in CASES[rule]]


def test_normalise_reports_what_it_rejects(spark):
    rows = spark.createDataFrame([(1, "https://a.com", "x@y.z"), (2, "bad host", ""), (3, None, "nope")], "k int, d string, e string")
    ok, rejected = norm.normalise(rows, {"d": "domain", "e": "email"}, "k")
    assert sorted(map(tuple, ok.collect()), key=str) == [(1, "a.com", "x@y.z"), (2, None, None), (3, None, None)]
    assert sorted(map(tuple, rejected.collect())) == [(2, "d", "bad host"), (3, "e", "nope")]


PHONES = {
    "+919000000001": "mobile", "+916120000000": "unknown", "+917900000000": "unknown", "+918012345678": "unknown", "+917012345678": "mobile", "+912212345678": "landline", "+9118001234567": "tollfree",
    "+911800123456": "landline", "+91180012345678": "unknown", "+442071234567": "unknown", "+91900000000": "unknown", None: "unknown",
}
DUMMIES = {"+91 99999 99999": True, "9898989898": False, "012-345-6789": True, "98765 43210": True, "0987654321": True, "12345": True, "": True, None: True, "01234567 12": True, "98765431": True, "7012345678": False}


def test_phone_rules(spark):
    rows = spark.createDataFrame([(p,) for p in PHONES], "p string").select("p", norm.phone_type(F.col("p")).alias("t"), norm.phone_country(F.col("p")).alias("c"))
    got = {r.p: (r.t, r.c) for r in rows.collect()}
    assert {p: t for p, (t, _) in got.items()} == PHONES and got["+442071234567"][1] == "GB" and got["+919000000001"][1] == "IN" and got[None][1] is None
    raw = spark.createDataFrame([(p,) for p in DUMMIES], "p string").select("p", norm.is_dummy_phone(F.col("p")).alias("d"))
    assert {r.p: r.d for r in raw.collect()} == DUMMIES


def test_whole_tables_are_folded_first(spark):
    rows = spark.createDataFrame([(1, "https://münchen.example/x", "ＡＣＭＥ　Labs"), (2, "ｅｘａｍｐｌｅ.org", None), (3, "ok.example", "plain"), (4, "a" * 64 + ".example", "")], "k int, d string, _d string")
    ok, rejected = norm.normalise(rows, {"d": "domain", "_d": "company_name"}, "k")
    assert sorted(map(tuple, ok.collect()), key=str) == [(1, "xn--mnchen-3ya.example", "acme labs"), (2, "example.org", None), (3, "ok.example", "plain"), (4, None, None)]
    assert [(r.k, r.column) for r in rejected.collect()] == [(4, "d")]


def test_changes_and_chips(spark):
    cases = [(0, 5, True, "new", None), (0, 0, True, "flat", None), (0, 5, False, "new", None), (20, 20, True, "pct", 0.0), (20, 25, False, "partial", None), (9, 18, True, "abs", None), (20, 25, True, "pct", 25.0)]
    rows = spark.createDataFrame([c[:3] for c in cases], "p int, c int, full boolean").select("p", "c", "full", change(F.col("p"), F.col("c"), F.col("full")).alias("x"))
    assert [(r.p, r.c, r.full, r.x.flag, r.x.pct) for r in rows.collect()] == cases
    chips = [(10, 8, 7, 7, "up", 25), (8, 8, 7, 7, "flat", None), (5, 0, 7, 7, "up", 100), (6, 7, 6, 7, "flat", None), (3, 7, 6, 7, "down", 50), (5, None, 7, 7, "na", None), (5, 5, 0, 7, "na", None), (7, 8, 7, 7, "down", 12)]
    rows = spark.createDataFrame([c[:4] for c in chips], "c int, p int, dc int, dp int").select("*", report.chip(F.col("c"), F.col("p"), F.col("dc"), F.col("dp")).alias("x"))
    assert [(r.c, r.p, r.dc, r.dp, r.x.kind, r.x.pct) for r in rows.collect()] == chips


def test_days_are_gaps_only_far_below_the_median_of_the_weekdays_before(spark):
    day = lambda n: dt.date(2024, 1, n)  # noqa: E731  the 1st is a Monday
    totals = {1: 900, 2: 0, 3: 100, 4: 100, 5: 100, 6: 0, 7: 3, 8: 100, 9: 4, 10: 5, 11: 100, 12: 40}
    events = spark.createDataFrame([(day(n),) for n, k in totals.items() for _ in range(k)], "ist_day date")
    days = spark.createDataFrame([(day(n),) for n in totals], "ist_day date")
    got = {r.ist_day.day: r.status for r in metrics.day_status(events, days, "2024-01-12", complete=False).collect()}
    assert got == {1: "ok", 2: "gap", 3: "ok", 4: "ok", 5: "ok", 6: "weekend", 7: "ok", 8: "ok", 9: "gap", 10: "ok", 11: "ok", 12: "partial"}


def test_fingerprints_tell_doubled_and_exchanged_rows(spark):
    rows = [("a", 1), ("a", 1), ("b", 2), ("b", 2), ("c", 1), ("c", 2), ("d", 2), ("d", 1), ("e", None), ("f", 1), ("f", 1), ("f", 1)]
    got = {r.g: r.hash for r in quality.fingerprint(spark.createDataFrame(rows, "g string, x int"), "g").collect()}
    assert got["c"] == got["d"] and len({got[g] for g in "abcef"}) == 5


def test_asof_join_by_stretches_equals_the_plain_one(spark):
    rng = random.Random(8)
    left = spark.createDataFrame([(rng.choice("ab"), rng.randint(0, 400), i) for i in range(400)], "k string, t int, i int")
    right = spark.createDataFrame([(rng.choice("ac"), rng.randint(50, 350), j) for j in range(40)], "k string, at int, v int").dropDuplicates(["k", "at"])
    for fill in (False, True):
        plain, cut = (sorted(map(tuple, asof_join(left, right, "k", "t", "at", "v", backward_fill=fill, bucket=b).collect()), key=str) for b in (None, lambda t: F.floor(t / 10)))
        assert plain == cut


def test_demand_over_stretches(spark):
    pool = spark.createDataFrame([("g", i) for i in range(97)] + [(None, 500)], "g string, p int")
    need = spark.createDataFrame([("g", "a", 40), ("g", "b", 0), ("g", "c", 3), ("g", "d", 100), (None, "e", 5)], "g string, who string, need int")
    got = {r.p: r.who for r in take_by_demand(pool, need, ["g"], [F.col("p")], [F.col("who")], "need", stretch=7).collect()}
    assert got == {i: "a" if i < 40 else "c" if i < 43 else "d" for i in range(97)}


def test_asof_join_takes_the_last_value_up_to_a_time(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 7, "y")], "k string, at int, v string")
    assert sorted(map(tuple, asof_join(left, right, "k", "t", "at", "v").collect()), key=str) == [("a", 1, None), ("a", 5, "x"), ("a", 9, "y"), ("b", 5, None)]
    assert asof_join(left, right, "k", "t", "at", "v", backward_fill=True).filter("k = 'a' AND t = 1").first().v == "x"


def test_rolling_distinct_and_demand(spark):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3))], "d int, day date")
    got = {r.day.day: r.n for r in rolling_distinct(rows, [], "d", "day", 2).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 1}
    pool = spark.createDataFrame([("g", i) for i in range(5)], "g string, p int")
    need = spark.createDataFrame([("g", "x", 2), ("g", "y", 0), ("g", "z", 9)], "g string, who string, need int")
    taken = {r.p: r.who for r in take_by_demand(pool, need, ["g"], [F.col("p")], [F.col("who")], "need").collect()}
    assert taken == {0: "x", 1: "x", 2: "z", 3: "z", 4: "z"}


def test_survivors_follow_pointers_and_stop_on_cycles(spark):
    rows = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (7, 8), (8, 7), (9, 8)], "entity int, merged_into int")
    assert {r.entity: r.survivor for r in identity.survivors(rows).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}


def test_keys_are_weak_only_in_a_source_that_shares_them(spark):
    claims = [(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "a", "y"), (5, "a", "y"), (6, "b", "y"), (7, "a", "z"), (8, "a", "z"), (9, "a", "z"), (10, "b", "z"), (11, "c", "z"), (12, "b", None)]
    rows = spark.createDataFrame(claims, "entity long, source string, domain string")
    ids = identity.identifiers(rows, [("domain", "domain")])
    assert sorted((r.entity, r.claims, r.strength) for r in ids.collect()) == [(i, 5 if v == "z" else 3, "weak" if (s, v) == ("a", "z") else "strong") for i, s, v in claims if v]
    labels = identity.golden(rows, identity.strong_claims(ids))
    assert {r.entity: r.golden for r in labels.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10, 12: 12}
    assert {r.sources: r.companies for r in identity.source_overlap(rows, labels).collect()} == {1: 4, 2: 2, 3: 1}


def test_validate_splits_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "k int, x int")
    ok, bad = quality.validate(rows, {"positive": F.col("x") > 0, "small": F.col("x") > -5})
    assert {r.k for r in ok.collect()} == {1, 2} and [(r.k, r.failed) for r in bad.collect()] == [(3, ["positive"])]


def test_raw_objects(spark, tmp_path):
    history = [{"value": "s2", "timestamp": "2024-01-02T00:00:00Z", "sourceType": "UI"}, {"value": "s1b", "timestamp": "2024-01-01T00:00:00Z"}, {"value": "s1a", "timestamp": "2024-01-01T00:00:00Z"}, {"value": "lost", "timestamp": None}]
    one = {"account": "p", "object_type": "deal", "id": "1", "properties": {"b": "2", "a": "1"}, "associations": {"company": [{"id": "9", "types": None}], "contact": [{"id": "5", "types": [{"typeId": 1, "label": "Primary"}]}, {"id": "6", "types": [{"typeId": 2, "label": None}]}]}, "history": {"stage": history}}
    other = dict(one, id="2", properties={"a": "1", "b": "2"}, associations={}, history={})
    (tmp_path / "x.json").write_text(json.dumps(one) + "\n" + json.dumps(other) + "\n")
    rows = files.read_raw_objects(spark, str(tmp_path))
    assert len({r.payload_sha256 for r in rows.collect()}) == 1
    assert [(r.value, r.seq) for r in files.explode_history(rows, "stage").orderBy("seq").collect()] == [("s1a", 1), ("s1b", 2), ("s2", 3)]
    assert {(r.to_id, r.is_primary) for r in files.explode_associations(rows).collect()} == {("9", True), ("5", True), ("6", False)}


def test_messy_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Report;\n\nname;name;\nCafé;x;y\n;;\nb;c;d;e\n".encode("cp1252"))
    (tmp_path / "b.csv").write_text("1,2\n3,4\n")
    (tmp_path / "b copy.csv").write_text("1,2\n3,4\n")
    rows = {(r.path.rpartition("/")[2].replace("%20", " "), r.row_number): r.cells for r in delimited.read_delimited(spark, str(tmp_path)).collect()}
    assert rows[("a.csv", 1)] == {"name": "Café", "name__2": "x", "col_3": "y"} and rows[("a.csv", 2)]["col_4"] == "e"
    assert rows[("b.csv", 1)] == {"col_1": "1", "col_2": "2"}
    catalog = files.file_catalog(spark, str(tmp_path), [("first", "b.*csv$")])
    assert {r.path.rpartition("/")[2].replace("%20", " "): r.canonical for r in catalog.collect()} == {"a.csv": True, "b.csv": True, "b copy.csv": False}


def test_sheets_and_tidy(spark):
    rows = files.sheet_rows(spark.createDataFrame([("t", 1, ["a", "", " "]), ("t", 2, ["", ""])], "tab string, row_number int, cells array<string>"))
    assert [r.cells for r in rows.collect()] == [["a"]]
    assert files.tidy(spark.createDataFrame([(1, 2, 3)], "k int, a int, b int"), ["k"], ["a", "b"]).count() == 2
    assert files.to_sorted_json(spark.createDataFrame([(1, None)], "b int, a int")).first().json == '{"a":null,"b":1}'


def test_days_are_replaced_not_added(spark, tmp_path):
    path = str(tmp_path / "facts")
    day = lambda n, v: (dt.date(2024, 1, n), v)
    for rows in ([day(1, 1), day(2, 2)], [day(2, 5)], [day(2, 5)]):
        files.write_days(spark.createDataFrame(rows, "ist_day date, v int"), path)
    assert sorted((r.ist_day.day, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 5)]


@pytest.fixture
def stream(spark):
    return spark.readStream.schema(spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001")


def run(df, mode, tmp_path):
    query = df.writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table("out")


def test_stream_counts_equal_the_batch(spark, stream, tmp_path):
    got = {(r.day, r.event_type): r.n for r in run(st.daily_entries(stream, ["event_type"]), "update", tmp_path).collect()}
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy(F.expr("cast(ts + INTERVAL 330 MINUTES as date)").alias("day"), "event_type").agg(F.count("*").alias("n"))
    assert got == {(r.day, r.event_type): r.n for r in batch.collect()}


def test_stream_deduplicates(spark, stream, tmp_path):
    twice = stream.withColumn("event_id", F.floor(F.col("event_id") / 2))
    assert run(st.deduplicated(twice, "event_id"), "append", tmp_path).count() == 500


def test_first_touch_state(spark, stream, tmp_path):
    got = {r.user_id: (r.first_time, r.n) for r in run(st.first_touch(stream), "update", tmp_path).collect()}
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("t"), F.count("*").alias("n"))
    assert got == {r.user_id: (r.t, r.n) for r in batch.collect()}


def test_first_touch_goes_on_after_a_restart(spark, tmp_path):
    schema, path, batches = "user_id long, ts timestamp, event_type string", str(tmp_path / "in"), []
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute)
    for rows in ([(1, at(5), "b"), (1, at(3), "a"), (2, at(1), "x")], [(1, at(2), "late"), (1, at(5), "c")], [(3, at(9), "y")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        touched = st.first_touch(spark.readStream.schema(schema).parquet(path))
        touched.writeStream.outputMode("update").foreachBatch(lambda b, n: batches.append(b.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = [sorted((r.user_id, r.first_time.minute, r.last_time.minute, r.stage, r.n) for r in b) for b in batches if b]
    assert got == [[(1, 3, 5, "b", 2), (2, 1, 1, "x", 1)], [(1, 2, 5, "c", 4)], [(3, 9, 9, "y", 1)]]


def test_batches_and_similar_names(spark):
    import difflib

    from sluice.operators import pages, projection

    names = [f"n{i * 37 % 100:03}" for i in range(100)]
    rows = pages.batches(spark.createDataFrame([(n,) for n in names], "name string"), "name", "name", 20).collect()
    assert {r.name: r.batch for r in rows} == {n: i // 20 for i, n in enumerate(sorted(names))}
    a, b = [(1, "acme labs", "x"), (2, "zeta", "x"), (3, "acme", "y")], [(7, "acme lab", "x"), (8, "acme labs india", "x"), (9, "acme", "x")]
    frames = [spark.createDataFrame(r, "id int, name string, block string") for r in (a, b)]
    got = {(r.left_id, r.right_id): r.similarity for r in projection.accept_names(*frames, "block").collect()}
    want = {}
    for i, x, p in a:
        for j, y, q in b:
            ratio = difflib.SequenceMatcher(None, x, y).ratio()
            ratio = max(ratio, 0.85) if x in y or y in x else ratio
            if p == q and ratio >= 0.55:
                want[i, j] = ratio
    assert got == want and len(got) == 3
