"""Shared helpers on small hard cases: hot keys, both sides of size limits, deleted scratch tables."""

import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sluice.functions import graph, ranks, staging


def brute_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize(("hot", "looked_up"), [(1, 128), (4, 128), (1000, 128), (4, 0)])
def test_components(spark, monkeypatch, hot, looked_up):
    monkeypatch.setattr(graph, "hot_share", lambda _: hot)
    monkeypatch.setattr(graph, "LOOKED_UP", looked_up)
    rng = random.Random(2)
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 140)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(90)] + [(5, 5), (-3, 100)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components([e for e in edges if e[0] != e[1]])
    assert got == want


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_placed(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab") if i % 5 else None, rng.choice([1, 2, 2, 2, 7, None])) for i in range(500)]
    frame = spark.createDataFrame(rows, "id long, g string, x long")
    got = {r.id: r.place for r in ranks.placed(frame, ["g"], [F.col("x"), F.col("id")], "place").collect()}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        assert [got[r[0]] for r in own] == list(range(len(own)))


def test_bounded_broadcast_counts_bytes(spark):
    small = spark.createDataFrame([(1, "x" * 100, [1, 2]), (2, None, None)], "a long, t string, l array<int>")
    size = staging.row_bytes(small)
    assert 100 < size < 1000 and staging.row_bytes(small.limit(0)) == 0
    hints = lambda df: df._jdf.queryExecution().logical().toString()
    assert "UnresolvedHint broadcast" in hints(staging.bounded_broadcast(small, size)) and "UnresolvedHint merge" in hints(staging.bounded_broadcast(small, size - 1))


def test_scratch_tables_go_and_kept_ones_stay(spark):
    with staging.scratch(spark):
        with staging.scratch(spark):
            gone, kept = staging.staged(spark.range(3), "gone"), staging.staged(spark.range(4), "kept", keep=True)
            paths = [df.inputFiles()[0].removeprefix("file://").rpartition("/")[0] for df in (gone, kept)]
            assert all(map(os.path.isdir, paths))
        assert not os.path.exists(paths[0]) and kept.count() == 4
    assert not os.path.exists(paths[1])
    assert staging.staged(spark.range(2), "free", keep=True).count() == 2


def test_a_cluster_has_to_name_its_shared_folder():
    def session(folder, master):
        values = {"spark.checkpoint.dir": folder, "spark.master": master}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: values[k]), sparkContext=SimpleNamespace(applicationId="some"))

    assert staging.shared_folder(session("s3://bucket/x/", "yarn")) == "s3://bucket/x"
    assert staging.shared_folder(session(None, "local[4]"))
    with pytest.raises(RuntimeError):
        staging.shared_folder(session(None, "yarn"))


def test_spread_join_of_missing_and_null_keys(spark):
    rows = spark.createDataFrame([(1, "a")] * 9 + [(2, "b"), (3, None), (4, "z")], "i long, k string")
    table = spark.createDataFrame([("a", 10), ("b", None), ("c", 30)], "at string, v long")
    hot = graph.hot_keys(rows, "k")
    got = graph.spread_join(rows, "k", table, "at", "v", hot, "found")
    assert sorted(map(tuple, got.select("i", F.coalesce("found", F.lit(0))).collect())) == [(1, 10)] * 9 + [(2, 0), (3, 0), (4, 0)]
