"""Centroids on bit planes, chat windows and importance resampling: against brute force on small hard cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import centroids, chat, resample

RNG = random.Random(11)


def written(spark, tmp_path_factory, rows, schema, parts=3):
    path = str(tmp_path_factory.mktemp("rows") / "d")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- centroids


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 27), st.randoms(use_true_random=False))
def test_planes_give_exact_dots(bits, rng):
    values = lambda n: np.array([[rng.randint(-(1 << bits), (1 << bits) - 1) for _ in range(64)] for _ in range(n)], dtype=np.int64)
    a, b = values(4), values(3)
    pa, pb = centroids.pack(a, bits + 1), centroids.pack(b, bits + 1)
    assert (centroids.unpack(pa) == a).all()
    assert (centroids.dots(pa, pb) == a @ b.T).all() and (centroids.squares(pa) == (a * a).sum(axis=1)).all()


def vectors():
    point = lambda c: [c + RNG.uniform(-0.2, 0.2) for _ in range(64)]
    rows = [(i, point(RNG.choice([-0.5, 0.0, 0.4])), "x") for i in range(60)]
    same = point(0.1)
    rows += [(100 + i, same, None) for i in range(40)] + [(100, same, None), (None, point(0.3), "y"), (7, point(0.2), "y")]
    bad = [(200, None, "n"), (201, [], "n"), (202, [0.5] * 63, "n"), (203, [0.5] * 65, "n"), (204, [0.5] * 63 + [None], "n"), (205, [0.5] * 63 + [float("nan")], "n"), (206, [0.5] * 63 + [float("-inf")], "n")]
    return rows + bad, rows


def lloyd(rows, k, rounds):
    x = [(v, [math.floor(256 * e) for e in vec]) for v, vec, _ in rows]
    first = sorted(x, key=lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest())[:k]
    centres = [list(c) for _, c in first]
    near = lambda e: min((sum((p - q) ** 2 for p, q in zip(e, c, strict=True)), i) for i, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(e)[1] for _, e in x]
        for i in set(at):
            own = [e for (_, e), a in zip(x, at, strict=True) if a == i]
            centres[i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return Counter((v, near(e)[1], near(e)[0]) for v, e in x), centres


@pytest.mark.parametrize("k", [4, 40])
def test_clusters_are_those_of_whole_number_rounds(spark, tmp_path_factory, k):
    rows, kept = vectors()
    table = written(spark, tmp_path_factory, rows, "vec_id long, embedding array<float>, cluster string")
    kept = [(v, np.array(e, dtype=np.float32).astype(float).tolist(), x) for v, e, x in kept]
    found, centres = centroids.centroid_clusters(table, k=k, rounds=3)
    expected, expected_centres = lloyd(kept, k, 3)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in found.collect()) == expected
    if k == 4:  # of more centroids some start at copies of one vector with one id
        assert centres.tolist() == expected_centres


def test_few_and_no_and_large_vectors(spark, tmp_path_factory):
    schema = "vec_id long, embedding array<double>, planes string"
    few = written(spark, tmp_path_factory, [(1, [1.0] * 64, ""), (2, [-1.0] * 64, "")], schema)
    found, centres = centroids.centroid_clusters(few)
    assert len(centres) == 2 and [r.distance for r in found.collect()] == [0, 0]
    none, centres = centroids.centroid_clusters(few.filter("vec_id > 5"))
    assert none.count() == 0 and len(centres) == 0
    large = written(spark, tmp_path_factory, [(1, [1e30] * 64, "")], schema)
    with pytest.raises(ValueError):
        centroids.centroid_clusters(large)


# ---------------------------------------------------------------- chat


TEMPLATE = chat.Template()
NASTY = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/", "s>", "a", "\n", "é", "𝔘", "[", "INST]", "$1"]), max_size=12).map("".join)


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    found = []

    @settings(deadline=None, max_examples=300, database=None)
    @given(NASTY)
    def gather(text):
        found.append((text,))

    gather()
    rows = spark.createDataFrame(found, "text string").select("text", TEMPLATE.escaped(F.col("text")).alias("e")).withColumn("back", TEMPLATE.unescaped(F.col("e"))).collect()
    assert all(r.back == r.text for r in rows)
    assert not any(c in r.e for r in rows for c in TEMPLATE.controls)


def conversations():
    words = lambda n: " ".join(RNG.choices(["ab", "c", "defg", "</s>", "[INST]", "é"], k=n))
    rows = []
    for conv in range(12):
        turns = [(conv, t, "user" if t % 2 == 0 else "assistant", words(RNG.randint(0, 25)), "x") for t in range(RNG.randint(1, 30))]
        rows += ([(conv, -1, "system", words(4), None)] if conv % 3 == 0 else []) + turns
    rows += [(50, 0, "system", "alone", None), (51, 0, "system", "two", None), (51, 1, "system", "heads", None), (52, 0, "user", "word " * 4000, None), (52, 1, "assistant", "x" * 5000, None)]
    rows += [(None, None, None, None, None), (None, 0, "assistant", "a", None), (53, 4, "assistant", "same", None), (53, 4, "assistant", "same", None), (53, None, "assistant", None, None), (54, 0, "", "", None)]
    rows += [(60, t, "assistant" if t % 2 else "user", words(3), None) for t in range(400)]
    return rows


def in_order(rows):
    out = {}
    for conv, turn, role, text, _ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in out.items()}


def tokens(text):
    return len(re.findall(chat.TOKEN, text)) + chat.MARKS


def windows_by_hand(turns, budget, history, stretch):
    """(start, repeated, fresh turns, tokens) one turn after another."""
    n = [tokens(t) for _, t in turns]
    before = [sum(n[:i]) for i in range(len(n))]
    head = 1 if turns[0][0] == "system" else 0
    lead = n[0] if head else 0
    if len(turns) == head:
        return [(0, 0, turns, lead)]
    spans, start = [], None
    for i in range(head, len(turns)):
        room = max(1, budget - lead - (history if start is not None and before[start] > lead else 0))
        if start is None or before[i] // (stretch * budget) != before[start] // (stretch * budget) or before[i] + n[i] - before[start] > room:
            spans.append([])
            start = i
        spans[-1].append(i)
    out = []
    for k, own in enumerate(spans):
        past = [j for j in range(head, own[0]) if before[own[0]] - before[j] <= history] if k else []
        again = ([0] if head and k else []) + past
        fresh = ([0] if head and not k else []) + own
        out.append((before[own[0]], len(again), [turns[i] for i in again + fresh], sum(n[i] for i in again + fresh)))
    return out


@pytest.mark.parametrize(("budget", "history", "stretch"), [(60, 20, 32), (60, 0, 2), (16, 16, 3), (512, 128, 32)])
def test_chat_windows(spark, tmp_path_factory, budget, history, stretch):
    rows = conversations()
    table = written(spark, tmp_path_factory, rows, "conv_id long, turn long, role string, text string, start string")
    windows = chat.chat_windows(table, budget=budget, history=history, stretch=stretch)
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", windows._jdf.queryExecution().executedPlan().toString())
    windows = windows.cache()
    turns = in_order(rows)
    got = {}
    for r in windows.collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(turns)
    plain = lambda s: re.sub(r"(?s)\\(.)", r"\1", s)
    for conv, own in got.items():
        own.sort(key=lambda r: r.start)
        expected = windows_by_hand(turns[conv], budget, history, stretch)
        said = [[tuple(map(plain, p.removeprefix("<s>[INST]").split("[/INST]"))) for p in r.formatted.split("</s>")[:-1]] for r in own]
        assert [(r.start, r.repeated, s, r.tokens) for r, s in zip(own, said, strict=True)] == expected
        targets = [plain(r.formatted[m.start : m.end]) for r in own for m in r.mask]
        assert targets == [t for role, t in turns[conv] if role == "assistant"]
        assert all(r.tokens <= budget or len(s) - r.repeated <= 2 for r, s in zip(own, said, strict=True))
    digests = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    for conv, own in turns.items():
        d = digests[conv]
        loss = "".join(t for r, t in own if r == "assistant")
        assert d.n_turns == len(own) and d.loss_chars == len(loss) and d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert d.formatted_chars == sum(len(r.formatted) for r in got[conv])
    windows.unpersist()


def test_no_conversations(spark, tmp_path_factory):
    table = written(spark, tmp_path_factory, conversations(), "conv_id long, turn long, role string, text string, start string")
    assert chat.chat_windows(table.filter("conv_id = 999")).count() == 0


# ---------------------------------------------------------------- resampling


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % resample.BUCKETS for n in (1, 2, 3) for i in range(len(w) - n + 1)]


@settings(deadline=None, max_examples=100)
@given(st.binary(max_size=40), st.binary(max_size=300))
def test_joined_crc(a, b):
    one = lambda x: np.array([x], dtype=np.uint32)
    assert resample.joined_crc(one(zlib.crc32(a)), one(zlib.crc32(b)), np.array([len(b)]))[0] == zlib.crc32(a + b)


@pytest.mark.parametrize("joined", [1, 7, 64, 1 << 20])
def test_features_of_joined_texts(monkeypatch, joined):
    monkeypatch.setattr(resample, "JOINED_BYTES", joined)
    monkeypatch.setattr(resample, "KEPT_WORDS", 5)
    texts = ["", "one", "Two words", "é\x00ß x1 y", "A b-c d\n\ne f", "same same same same", " lead and trail ", "x" * 500 + " " + "y z " * 40, "", "last"]
    words, got = resample.Words(), [Counter() for _ in texts]
    n_words = Counter()
    for owners, buckets, of in resample.features_of([t.encode() for t in texts], words):
        n_words.update(of.tolist())
        for o, b in zip(owners.tolist(), buckets.tolist(), strict=True):
            got[o][b] += 1
    for i, t in enumerate(texts):
        w, f = features(t)
        assert got[i] == Counter(f) and n_words[i] == len(w)


def test_resample(spark, tmp_path_factory):
    vocabulary = ["".join(RNG.choices("abcdEFé1", k=RNG.randint(1, 7))) for _ in range(200)]
    prose = lambda n, k=200: " ".join(RNG.choices(vocabulary[:k], k=n))
    texts = [None, "", " . ", prose(19), prose(20)] + [prose(RNG.randint(1, 120)) for _ in range(150)] + [prose(60, 20) for _ in range(30)] + [prose(30000)]
    rows = [(i, t, "w", "s") for i, t in enumerate(texts)] + [(None, prose(40), None, None), (9, texts[9], None, None), (9, texts[9], None, None)]
    docs = written(spark, tmp_path_factory, rows, "doc_id long, text string, weight string, n_words string")
    bench = [(prose(50, 20),) for _ in range(20)] + [(None,), ("",)]
    target = written(spark, tmp_path_factory, bench, "text string")
    for against in (target, target.filter("text = 'none'")):
        s, t = Counter(), Counter()
        for _, x, *_ in rows:
            s.update(features(x)[1])
        for (x,) in bench if against is target else []:
            t.update(features(x)[1])
        all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
        gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10000)]
        expected = []
        for i, x, *_ in rows:
            w, f = features(x)
            h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
            weight = sum(gain[b] for b in f)
            expected.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        got = resample.resample(docs, against).collect()
        assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(expected)
        able = sorted((-e[4], e[0] is None, e[0] or 0) for e in expected if e[1] >= 20)
        best = able[: 5 * len(able) // 100]
        assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == best
        drawn = resample.drawn_documents(docs, against)
        assert drawn.columns == docs.columns
        assert sorted((x is None, x or 0) for x in (r.doc_id for r in drawn.collect())) == sorted(b[1:] for b in best)
    assert resample.resample(docs.filter("doc_id = -1"), target).count() == 0
