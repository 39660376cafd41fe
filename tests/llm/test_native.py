"""Operators that are DataFrame functions only: their results on small hard cases, and that no Python runs in their plans."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from sluice.llm import dedup, mixing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _file string, keep_id string"
ROWS = [
    (1, "Hello World", "en", "a", 11, "x", "y"), (2, "hello world", "en", "b", 11, None, None), (3, "HELLO WÖRLD", None, None, 11, None, None), (4, "hello wörld", "de", "b", 11, None, None),
    (5, None, None, None, None, None, None), (6, "", "en", "a", 0, None, None), (7, None, "en", "a", None, None, None), (None, "hello world", "en", "c", 11, None, None),
    (8, "a b c a b c d", "en", "a", 13, None, None), (9, "x\ny\nx\n\n \nx", "en", "a", 9, None, None), (10, " ".join(f"w{i}" for i in range(60)), "en", "a", 0, None, None),
    (11, " ".join(["same"] * 80), "en", "b", 0, None, None), (12, "long " * 20000, "en", "b", 0, None, None), (13, "#*$ %&| <>", "en", "b", 0, None, None), (13, "#*$ %&| <>", "en", "b", 0, None, None),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


EXTREME = "doc_id long, text string, source string, lang string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


def expected_groups():
    groups = {}
    for r in ROWS:
        groups.setdefault(lower(r[1]), []).append(r[0])
    return groups


@pytest.mark.parametrize("digest", [dedup.sha256, lambda norm: F.substring(norm, 1, 3)], ids=["sha256", "clashing"])
def test_exact_dedup(docs, digest):
    rows = dedup.exact_dedup(docs, digest).join(docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).distinct(), F.col("doc_id").eqNullSafe(F.col("d")))
    groups = expected_groups()
    got = dedup.exact_dedup(docs, digest)
    no_python(got)
    got = got.collect()
    assert len(got) == len(ROWS) and sum(r.kept for r in got) == len(groups)
    for r in rows.collect():
        own = groups[lower(r.t)]
        assert r.group_size == len(own) and r.keep_id == max(x for x in own if x is not None)


@pytest.mark.parametrize("most", [0, 1 << 30])
def test_exact_dedup_by_broadcast_or_by_salts(docs, most):
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in dedup.exact_dedup(docs, broadcast_bytes=most, salts=3).collect())
    want = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in dedup.exact_dedup(docs).collect())
    assert got == want
    clash = dedup.exact_dedup(docs, lambda norm: F.substring(norm, 1, 3), broadcast_bytes=most, salts=3).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in clash) == want


def test_state_goes_on_from_its_checkpoint(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "digest string, doc_id long, _file string, _row long"

    def state():
        return {r.digest: (r.keep.doc_id, r.n) for r in dedup.keyed_state(spark.readStream.schema(schema).parquet(source), checkpoint).collect()}

    spark.createDataFrame([("a", 1, "f", 0), ("a", 3, "f", 1), ("b", None, "f", 2)], schema).write.parquet(source)
    assert state() == {"a": (3, 2), "b": (None, 1)}
    assert state() == {"a": (3, 2), "b": (None, 1)}  # a restart without new rows
    spark.createDataFrame([("a", 2, "g", 0), ("b", 7, "g", 1), ("c", 1, "g", 2)], schema).write.mode("append").parquet(source)
    assert state() == {"a": (3, 3), "b": (7, 2), "c": (1, 1)}


def test_drop_copies_keeps_columns_and_one_of_each(docs):
    kept = dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(lower(r.text) for r in kept.collect()) == sorted(expected_groups())


def features(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 5000 else set(range(len(words)))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_quality_features(docs):
    rows = quality.host_quality(docs)
    no_python(rows)
    want = sorted((r[0] or -1, *features(r[1])) for r in ROWS)
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows.collect()) == want
    for r in rows.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_hosts_with_mostly_failing_documents_are_rejected_and_others_are_not(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good if i % 50 == 0 else bad, "junk") for i in range(200)] + [(1000 + i, bad if i % 10 == 0 else good, f"site{i % 7}") for i in range(700)] + [(5000, bad, "tiny"), (5001, good, None)]
    kept = {r.doc_id: r.kept for r in quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(kept[i] for i in range(200))
    assert all(kept[1000 + i] == (i % 10 != 0) for i in range(700)) and kept[5001] and not kept[5000]


def test_small_hosts_are_judged_by_the_same_law(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good, f"site{i % 9}") for i in range(900)] + [(2000 + i, bad, "junk") for i in range(28)] + [(3000, good, "junk")] + [(4000 + i, bad, "three") for i in range(3)] + [(4010, good, "three")]
    kept = {r.doc_id: r.kept for r in quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not kept[3000] and kept[4010] and all(kept[i] for i in range(900))
    n, k = {"junk": 29, "three": 4} | {f"site{i}": 100 for i in range(9)}, {"junk": 28, "three": 3}
    total = sum(n.values())
    mean = sum(k.values()) / total
    spread = sum(k.get(h, 0) ** 2 / n[h] for h in n) / total - mean**2 - mean * (1 - mean) * len(n) / total
    strength = min(total, max(1.0, mean * (1 - mean) / spread - 1))
    rates = quality.host_rates(quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("host", "base_failed"))
    for r in rates.collect():
        rate = (k.get(r.host, 0) + mean * strength) / (n[r.host] + strength)
        assert math.isclose(r.rate, rate) and math.isclose(r.deviation, math.sqrt(rate * (1 - rate) / (n[r.host] + strength + 1)))


def test_windows_are_told_apart_by_their_words(spark, monkeypatch):
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(7).cast("long"))  # every hash clashes
    texts = ["a b c d a b c", "a b c d e f", "x y z x y z x y z", "one two", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality.with_features(rows, F.coalesce("text", F.lit(""))).collect()}
    assert [got[i] for i in range(5)] == [features(t)[4] for t in texts] == [6, 0, 9, 0, 0]


def test_keep_good(docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {10}


def fair_targets(sizes, share=1.5, weights=(5, 2, 1), cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix_targets_and_copies(spark):
    texts = [(i, " ".join(["w"] * (1 + i * 7919 % 97)), f"s{(i * i) % 11}" if i % 13 else None) for i in range(3000)] + [(4000 + i, None, "empty") for i in range(3)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string")
    mixed = mixing.mix(frame)
    no_python(mixed)
    mixed = mixed.collect()
    source = {i: s for i, _, s in texts}
    sizes = {}
    for i, t, s in texts:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = fair_targets(sizes), {}
    for r in mixed:
        assert r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, want[source[r.doc_id]], abs_tol=1e-6)
        assert r.taken == r.size * r.copies and r.taken <= 2 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 100 for s in sizes)
    assert sorted(map(tuple, mixing.mix(frame).select("doc_id", "taken").collect())) == sorted((r.doc_id, r.taken) for r in mixed)


def test_mix_spreads_a_source_over_buckets(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "w " * (i % 5 + 1), "hot") for i in range(500)], "doc_id long, text string, source string")
    one = sorted(map(tuple, mixing.mix(frame).select("doc_id", "taken").collect()))
    monkeypatch.setattr(mixing.common, "BUCKET_ROWS", 10)
    monkeypatch.setattr(mixing.common, "bucket_count", lambda rows: 37)
    assert sorted(map(tuple, mixing.mix(frame).select("doc_id", "taken").collect())) == one


def test_mixed_documents(docs):
    taken = {(r._file, r._row): r.copies for r in mixing.mix(docs).collect()}
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mixed_documents(docs).count() == sum(taken.values())


def test_shards(spark, monkeypatch):
    import zlib

    rows = [(i, "x" * (i * 37 % 211) if i % 9 else None, ("hot" if i % 3 else f"s{i % 7}") if i % 11 else None, "en" if i % 4 else None) for i in range(4000)] + [(9999, "é" * 50, "a", "b")] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    monkeypatch.setattr(sharding.common, "bucket_count", lambda rows: 7)
    out = sharding.with_slots(sharding.kd_shards(frame, 8))
    no_python(out)
    out = out.collect()
    assert len(out) == len(rows)
    total = {}
    for r in out:
        total.setdefault(r.shard, []).append(r)
    # rows that share doc_id and text can't be parted: they are 300 * 116 bytes in one shard
    assert set(total) == set(range(8))
    even = sharding.with_slots(sharding.kd_shards(frame.filter("doc_id < 9999"), 8)).collect()
    sums = {}
    for r in even:
        sums[r.shard] = sums.get(r.shard, 0) + r.size
    assert max(sums.values()) - min(sums.values()) < 1000
    for own in total.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in out)


def brute_tree(points, dims, leaves, first, whole):
    """The same law by sorting: the widest dimension, cut where the weight left of it is nearest to its share."""
    if leaves == 1 or not points:
        return {p["i"]: first for p in points}
    code = lambda p, d: p[d] >> sharding.TIE_BITS
    wide = [(max(code(p, d) for p in points) - min(code(p, d) for p in points)) / max(1, whole[d]) for d in dims]
    d, left = dims[wide.index(max(wide))], leaves // 2
    goal, weights = sum(p["size"] for p in points) * left / leaves, {}
    for p in points:
        weights[p[d]] = weights.get(p[d], 0) + p["size"]
    before, cut = 0, 0
    for at in sorted(weights):
        if before <= goal:
            cut, start = at, before
        before += weights[at]
    cut += goal - start > weights[cut] / 2
    below, above = [p for p in points if p[d] < cut], [p for p in points if p[d] >= cut]
    return brute_tree(below, dims, left, first, whole) | brute_tree(above, dims, leaves - left, first + left, whole)


@pytest.mark.parametrize("shards", [8, 11])
def test_shards_are_those_of_a_tree_built_by_sorting(spark, tmp_path, shards):
    rows = [(i if i % 50 else None, "x" * (i * 37 % 211) if i % 9 else None, ("hot" if i % 3 else f"s{i % 7}") if i % 11 else None, "en" if i % 4 else None) for i in range(1500)] + [(77, "same", "hot", "en")] * 40
    spark.createDataFrame(rows, EXTREME).repartition(3).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    dims = [f"_{d}" for d in sharding.DIMENSIONS]
    points = [r.asDict() | {"i": i} for i, r in enumerate(sharding.coordinates(frame).collect())]
    whole = {d: max(p[d] >> sharding.TIE_BITS for p in points) - min(p[d] >> sharding.TIE_BITS for p in points) for d in dims}
    want = brute_tree(points, dims, shards, 0, whole)
    key = lambda p: (p["doc_id"] or -1, p["size"], p["text_crc32"], p["tie"])
    got = sorted((*key(r.asDict()), r.shard) for r in sharding.kd_shards(frame, shards).collect())
    assert got == sorted((*key(p), want[p["i"]]) for p in points)
    sizes = {}
    for *_, size, _, _, shard in got:
        sizes[shard] = sizes.get(shard, 0) + size
    assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) < 1000


def test_shards_of_extreme_ids_and_equal_rows(spark):
    rows = [(-(2**63), "a", None, None), (2**63 - 1, "b", "s", "en"), (None, None, None, None), (0, "", "s", None)] + [(5, "equal", "s", "en")] * 800
    out = sharding.with_slots(sharding.kd_shards(spark.createDataFrame(rows, EXTREME), 4)).collect()
    counts = {}
    for r in out:
        counts[r.shard] = counts.get(r.shard, 0) + r.size
    assert len(out) == len(rows) and len(counts) == 4 and max(counts.values()) - min(counts.values()) <= 100


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA.replace(", _file string, keep_id string", ""))
    for rows in (dedup.exact_dedup(empty), quality.host_quality(empty), mixing.mix(empty), sharding.with_slots(sharding.kd_shards(empty))):
        assert rows.count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_shared_folder_is_the_clusters_or_one_for_the_application():
    from types import SimpleNamespace

    from sluice.llm import common

    session = lambda folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=SimpleNamespace(applicationId="app"))
    assert common.shared_folder(session("file:///shared/")) == "file:///shared"
    own = common.shared_folder(session(None))
    assert own and own == common.shared_folder(session(None))
