"""The pipeline's stages one after another against brute force, hosts that a query rejects, and dense groups of near copies."""

import math
import random
import re
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import mixing, ngram_join, packing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    """Good texts, short and repetitive ones, exact copies in other cases, near copies, and a host of which most fail."""
    rng = random.Random(17)
    words = ["".join(rng.choices("abcdefghijk", k=rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: rng.choices(words, k=n)
    texts = []
    for i in range(120):
        own = prose(rng.randint(55, 200))
        texts.append((" ".join(own), f"s{i % 4}"))
        if i % 4 == 0:
            texts.append((" ".join(own).upper(), f"s{i % 3}"))
        if i % 5 == 0:
            at = rng.randrange(len(own))
            texts.append((" ".join(own[:at] + ["changed"] + own[at + 1 :]), "s1"))
    texts += [(" ".join(prose(10)), "s2") for _ in range(20)] + [("same words here " * 40, "s0"), (None, "s1"), ("", None)]
    texts += [(" ".join(prose(5)), "bad") for _ in range(100)] + [(" ".join(prose(90)), "bad") for _ in range(4)]
    rng.shuffle(texts)
    return [(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(texts)]


def base_failed(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    places = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    return len(words) < 50 or 100 * len(places) > 50 * len(words)


def rejected_hosts(rows):
    hosts = {}
    for _, text, _, source, _ in rows:
        hosts.setdefault(source, []).append(base_failed(text))
    n, k = {h: len(f) for h, f in hosts.items()}, {h: sum(f) for h, f in hosts.items()}
    all_n = sum(n.values())
    mean = sum(k.values()) / all_n
    spread = sum(k[h] ** 2 / n[h] for h in n) / all_n - mean**2 - mean * (1 - mean) * len(n) / all_n
    strength = min(all_n, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else all_n
    rate = {h: (k[h] + mean * strength) / (n[h] + strength) for h in n}
    return {h for h in n if rate[h] - 3 * math.sqrt(rate[h] * (1 - rate[h]) / (n[h] + strength + 1)) > 0.8}


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def least_of_near(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in ids if find(i) == i}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_each_stage_keeps_what_brute_force_keeps(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
    rows = corpus()
    rejected = rejected_hosts(rows)
    assert rejected == {"bad"}
    expected = {r[0]: r for r in rows if not base_failed(r[1]) and r[3] not in rejected}
    assert {r.doc_id for r in kept[0].collect()} == set(expected)
    last = {}
    for r in expected.values():
        key = re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
        last[key] = max(last.get(key, -1), r[0])
    expected = {i: expected[i] for i in last.values()}
    assert {r.doc_id for r in kept[1].collect()} == set(expected)
    near = least_of_near(list(expected.values()))
    assert len(near) < len(expected)
    assert {r.doc_id for r in kept[2].collect()} == near

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/near_copies/*.parquet')")
    taken = {i: (t, s) for i, t, s in con.sql(f"SELECT doc_id, taken, size FROM ({mixing.OP7_SQL})").fetchall()}
    copies = Counter(r.doc_id for r in kept[3].collect())
    assert {i: t // s for i, (t, s) in taken.items() if t} == copies and max(copies.values()) <= 2
    assert all(c.columns == docs_.columns for c, docs_ in zip(kept[:4], [spark.read.parquet(f"{folder}/documents.parquet")] * 4, strict=True))

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: len(encode.encode(rows[i][1], add_special_tokens=False).ids) + 1 for i in copies}
    pieces = kept[4].collect()
    assert Counter({i: n * copies[i] for i, n in tokens.items()}) == sum((Counter({p.doc_id: p.length}) for p in pieces), Counter())
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0) and p.doc_tokens == tokens[p.doc_id]
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values()) <= 1024


def test_the_query_rejects_a_host(spark, folder):
    rows = {r.doc_id: r for r in quality.op10_host_quality(spark, folder).collect()}
    good_of_bad = [r[0] for r in corpus() if r[3] == "bad" and not base_failed(r[1])]
    assert len(good_of_bad) == 4 and not any(rows[i].kept or rows[i].base_failed for i in good_of_bad)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert sorted(con.sql(f"SELECT doc_id, kept FROM ({quality.OP10_SQL})").fetchall()) == sorted((i, r.kept) for i, r in rows.items())


def test_every_document_of_a_dense_group_has_its_links(spark, tmp_path):
    rng, words, n = random.Random(3), [f"w{i}" for i in range(150)], 700
    rows = [(i, " ".join(words[:k] + [f"x{i}"] + words[k + 1 :])) for i in range(n) for k in [rng.randrange(150)]]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    found = ngram_join.ngram_join(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {r.class_id for r in found} == {0} and min(r.n_links for r in found) >= 0.9 * (n - 1)
    assert sum(r.n_links for r in found) >= 0.99 * n * (n - 1)


def test_fewer_parts_than_the_bytes_ask_for(spark, folder):
    from sluice.llm import common

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    encode, expected = public_tokenizers.path("byte_bpe_50k.json"), None
    for most in (3, 10_000):
        with common.small_batches(spark, 100):
            pieces = packing.pack(docs, encode, 0, 64, part_bytes=2000, most_parts=most).cache()
        parts = {p.sequence_id >> 40 for p in pieces.collect()}
        assert len(parts) <= 3 if most == 3 else len(parts) > 10
        total = pieces.groupBy("doc_id").sum("length").collect()
        total = sorted(map(tuple, total), key=str)
        assert expected in (None, total)
        expected = total
        pieces.unpersist()
