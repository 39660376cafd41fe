"""Operators with Python inside tasks, against brute force on small hard cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import common, dedup, lm_score, mixing, ngram_join, packing, quality, repeats, run_index, secrets, token_store
from sluice.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, tie string, curve string, part string, anchor string"
RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefghij", k=RNG.randint(1, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


BASE = prose(150)
TEXTS = [None, "", " ", "one", "One", "a b c d", "a b c d e f", BASE, BASE, BASE + " tail of words", "x " + BASE, prose(700), "long" * 30000, prose(40) + "\n\n  odd space " + prose(40)]
TEXTS += [" ".join(w if i not in (k, k + 60) else "edit" for i, w in enumerate(BASE.split())) for k in range(10, 40)] + [prose(80) for _ in range(25)]
TEXTS += ["a <|endoftext|> b", "<|startoftext|>A<|endoftext|>", "<|endoftext|>"]
ROWS = [(i, t, None, "c", "p", "q") for i, t in enumerate(TEXTS)] + [(7, BASE, None, "c", "p", "q"), (None, "no id", None, "c", "p", "q")]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def encoded(file, end):
    t = Tokenizer.from_file(public_tokenizers.path(file))
    return {(r[0], r[1]): np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, end], dtype="<u4") for r in ROWS}


def test_pack(docs):
    ids = {}
    for (doc_id, _), x in encoded("byte_bpe_50k.json", 0).items():
        ids.setdefault(doc_id, x)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, 64).collect()
    pieces, sequences = {}, {}
    for r in rows:
        assert bytes(r.ids) == ids[r.doc_id][r.start : r.start + r.length].tobytes() and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, own in pieces.items():
        copies = sum(r[0] == doc_id for r in ROWS)
        assert sum(n for _, n in own) == copies * len(ids[doc_id])
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 64
    assert len(sequences) <= sum(map(len, ids.values())) // 64 + 1 + 8 + 5


@pytest.mark.parametrize("part_bytes", [2000, 20_000])
def test_parts_have_about_equal_bytes_and_every_piece(docs, spark, part_bytes):
    ids = {r[0]: len(x) for r, x in zip(ROWS, encoded("byte_bpe_50k.json", 0).values(), strict=False)}
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, 64, part_bytes=part_bytes).collect()
    whole = sum(r.length for r in rows)
    assert whole == sum(len(encoded("byte_bpe_50k.json", 0)[r[0], r[1]]) for r in ROWS) and ids
    texts = spark.createDataFrame([(i, "ab " * (20 if i % 100 else 5000)) for i in range(3000)], "doc_id long, text string")
    keyed = texts.select("doc_id", F.xxhash64("doc_id").alias("tie"), "text")
    borders = packing.part_borders(keyed, part_bytes * 5)
    parts = sum(3 * (20 if i % 100 else 5000) + 1 for i in range(3000)) // (part_bytes * 5) + 1
    assert 0.4 * parts <= len(borders) + 1 <= parts and borders == sorted(set(borders)) and packing.part_borders(keyed.limit(0)) == []


def test_hilbert_keys_visit_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = packing.hilbert_keys((cells + 0.5) / (1 << bits), bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_token_store(docs, spark, tmp_path):
    path = str(tmp_path / "orc")
    token_store.write_token_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), 1, stride=1000)
    got = sorted(map(tuple, token_store.describe_token_store(spark, path).collect()), key=lambda r: (r[0] is not None, r))
    ids = encoded("word_bpe_49k.json", 1)
    start, want = 0, []
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0])):
        own = ids[r[0], r[1]]
        want.append((r[0], start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert got == want
    assert [len(r.ids) for r in token_store.read_token_store(spark, path).filter("doc_id = 11").collect()] == [len(ids[11, TEXTS[11]])]


def test_token_store_files_hold_run_lengths_indexes_and_bloom_filters(docs, spark, tmp_path):
    path = str(tmp_path / "orc")
    many = spark.range(6000).select((F.col("id") * 7 % 6000).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    token_store.write_token_store(many, path, public_tokenizers.path("word_bpe_49k.json"), 1, stride=1000)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kinds, encodings = set(), set()
    for file in spark.read.orc(path).inputFiles():
        orc = jvm.org.apache.orc
        reader = orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), orc.OrcFile.readerOptions(conf))
        assert reader.getRowIndexStride() == 1000
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            kinds |= {str(s.getKind()) for s in footer.getStreamsList()}
            encodings |= {str(c.getKind()) for c in footer.getColumnsList()}
        rows.close()
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds and "DIRECT_V2" in encodings
    assert spark.conf.get("spark.sql.orc.filterPushdown") == "true"
    for wanted in (4321, 10_000):  # in one group of rows; in none, though between the least and the largest of no file
        found = token_store.read_token_store(spark, path).filter(F.col("doc_id") == wanted)
        assert found.count() == (wanted < 6000)
        plan = found._jdf.queryExecution().executedPlan()
        found.collect()
        assert f"EqualTo(doc_id,{wanted})" in plan.toString()


def shingles(text):
    words = (text or "").lower().split(" ") if text and text.strip(" ") else []
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize(("limit", "block"), [(64, 256), (2, 3)])
def test_ngram_join(docs, monkeypatch, limit, block):
    monkeypatch.setattr(ngram_join, "LIMIT", limit)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sets = {}
    for doc_id, text, *_ in ROWS:
        own = frozenset(shingle_sets(pa.array([text], pa.string())).__next__().tolist())
        sets.setdefault(own or (doc_id,), []).append(doc_id)
    nodes = [s for s in sets if isinstance(s, frozenset)]
    links = {n: [m for m in nodes if m != n and len(n & m) >= 0.8 * len(n | m)] for n in nodes}
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(docs).collect()}
    for key, ids in sets.items():
        seen, todo = {key}, [key]
        while todo:
            for m in links.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        least = min((i for s in seen for i in sets[s] if i is not None), default=None)
        for i in ids:
            assert got[i] == (least, len(links.get(key, [])))
    assert sum(n > 0 for _, n in got.values()) >= 30


def test_shingles_are_runs_of_five_words_of_any_white_space():
    x, y, z, few, none = shingle_sets(pa.array(["A b\tc\nd  e f", " a B c d e", "b c d e f", "a b", " \n"]))
    assert len(x) == 2 and len(y) == len(z) == len(few) == 1 and not len(none)
    assert set(x) == {*y, *z}
    texts = [t for t in TEXTS if t and " " not in t and "\n" not in t]
    assert [len(s) for s in shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_drop_near_copies(docs):
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 7 in ids and ids.count(7) == 1 and not {8, 9, 10, 14, 20} & set(ids) and {0, 1, 2, 3, 11, 12, 13} <= set(ids)


def test_drop_near_copies_tells_classes_apart_by_links(spark):
    rng = random.Random(3)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(100)) for _ in range(4))
    rows = [(5, a), (9, a + " more"), (5, b), (10, b + " more"), (None, c), (None, c + " more"), (None, d), (12, None), (12, "")]
    kept = ngram_join.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept if r.text and r.doc_id is not None) == [5, 5] and {a, b, d} <= {r.text for r in kept}
    assert len(kept) == 6 and len({c, c + " more"} & {r.text for r in kept}) == 1


def brute_repeats(texts, length):
    counts = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            counts[t[p : p + length]] = counts.get(t[p : p + length], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = True
        yield gone


@pytest.mark.parametrize("group", [1024, 1])
def test_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    shared, line = prose(60), "licence " * 20 + "é"
    texts = [None, "", "short", prose(120), BASE, BASE, BASE[:400] + prose(30), prose(30) + BASE[300:], shared[:199], shared[:199] + "!", "z" * 500, "z" * 201, "z" * 200, BASE[5:210]]
    texts += [prose(20) + shared[:250] + prose(20) for _ in range(3)] + [prose(RNG.randint(1, 40)) + line + prose(30) for _ in range(6)] + ["ab" * 150 + "c", prose(50) * 2]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, file string")).collect()}
    data = [(t or "").encode() for t in texts]
    for i, (b, gone) in enumerate(zip(data, brute_repeats(data, repeats.LENGTH), strict=True)):
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (got[i].n_bytes, sum(e - s for s, e in got[i].removed), len(got[i].removed), got[i].kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=12), st.text("ab", max_size=12)), min_size=1, max_size=8))
def test_run_index_gives_matching_statistics(parts):
    strings, anchors = [(a + b).encode() for a, b in parts], [len(a) for a, _ in parts]
    index = run_index.RunIndex(strings, anchors)
    best = index.statistics()

    def match(s, a, p, t, b, q):
        n = 0
        while p + n < len(s) and q + n < len(t) and s[p + n] == t[q + n] and (p + n < a) == (q + n < b) and (a - p == b - q or (p + n < a and q + n < b)):
            n += 1
        return n

    for k, (s, a) in enumerate(zip(strings, anchors, strict=True)):
        for p in range(a + 1):
            others = ((t, b, q) for j, (t, b) in enumerate(zip(strings, anchors, strict=True)) for q in range(b + 1) if (j, q) != (k, p))
            assert best[index.starts[k] + p] == max((match(s, a, p, *o) for o in others), default=0)


def test_anchors_agree_in_equal_strings(monkeypatch):
    text = np.frombuffer((prose(300) + "z" * 700 + "ab" * 400).encode(), dtype=np.uint8)
    at, hashes, first, last = repeats.anchors(text)
    assert first[0] == 0 and last[-1] == len(text) - repeats.LENGTH and (first[1:] == last[:-1] + 1).all()
    for a, h, f, t in zip(at, hashes, first, last, strict=True):
        for s in {int(f), int(t)}:
            alone = repeats.anchors(text[s : s + repeats.LENGTH])
            assert (alone[0][0] + s, alone[1][0]) == (a, h)
    monkeypatch.setattr(repeats, "STRETCH", 512)
    cut = repeats.anchors(text)
    whole = {s: (a, h) for a, h, f, t in zip(at, hashes, first, last, strict=True) for s in range(f, t + 1)}
    assert sum(t - f + 1 for _, _, f, t in zip(*cut, strict=True)) == len(whole)


def test_secrets():
    text = 'x password = "hunter2hunter2" AKIA' + "A1B2" * 5 + " é " + "0123456789abcdef" * 2 + " token: ab PASSWD:short API-KEY=nothere12345 secret=token=abcdefgh"
    found = secrets.find_secrets(text)
    assert [(k, text[s:e]) for k, s, e in found if k == "assign"] == [("assign", 'password = "hunter2hunter2'), ("assign", "secret=token=abcdefgh")]
    assert [text[s:e] for k, s, e in found if k in ("access", "hex")] == ["AKIA" + "A1B2" * 5, "0123456789abcdef" * 2]
    key = "q8Zr3TmX0vLk9WcY2bNh7JfP"
    assert [(k, text[s:e]) for text in (f"see {key} there",) for k, s, e in secrets.find_secrets(text)] == [("entropy_mixed", key)]
    for clean in (BASE, "z" * 400, "550e8400-e29b-41d4-a716-446655440000", "4785380592391139 4785380592391139", "http://example.com/a/b/C1d2", "sha256-" + key, "internationalization" * 3):
        assert secrets.find_secrets(clean) == []


def test_secrets_of_every_character_class():
    lower, upper, letters, mixed = "k3v9x0qz7m2p8w4hd6tj1rby5n", "JBSWY3DPEHPK3PXPQ2ZT7MVLR5KW", "qZrTmXvLkWcYbNhJfPsDgQwE", "q8Zr3TmX0vLk9WcY2bNh7JfP"
    for kind, key in (("entropy_lower", lower), ("entropy_upper", upper), ("entropy_letters", letters), ("entropy_mixed", mixed)):
        text = f"see {key} there"
        assert [(k, text[s:e]) for k, s, e in secrets.find_secrets(text)] == [(kind, key)]
    fixed = "0123456789abcdef"[::-1] * 2
    for text in (f"{fixed}-{mixed}", f"{mixed}-{fixed}", f"{mixed}-{fixed}-{mixed}"):
        found = [(k, text[s:e].strip("-")) for k, s, e in secrets.find_secrets(text)]
        assert set(found) == {("hex", fixed), ("entropy_mixed", mixed)} and len(found) == text.count("-") + 1
    for clean in ("anUnusuallyLongNameOfSomething", "AN_UNUSUALLY_LONG_NAME_OF_SOMETHING_2", "internationalization2024", "Donaudampfschifffahrtsgesellschaft", "12345678901234567890"):
        assert secrets.find_secrets(clean) == []


@settings(max_examples=100, deadline=None)
@given(st.text("abcXYZ0189", min_size=20, max_size=60))
def test_entropy_windows(text):
    from math import log2

    want = set()
    for i in range(len(text) - 19):
        w = text[i : i + 20]
        h = -sum(w.count(c) / 20 * log2(w.count(c) / 20) for c in set(w))
        if h >= 2.9 - 1e-9:
            want |= set(range(i, i + 20))
    got = {p for s, e in secrets.entropy_windows(text, 20, 2.9 - 1e-9, ()) for p in range(s, e)}
    assert got == want


def test_secret_query_digests_what_is_found(spark):
    rows = secrets.op9_secrets(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        found = secrets.find_secrets(texts[r.doc_id])
        base = [f for f in found if f[0] in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(f[0] == k for f in base) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in found)
    assert any(r.n_hex for r in rows)


WORD = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


def scanned_base(text):
    """The contract's three patterns by hand, a character at a time."""
    found, i = [], 0
    names = ("password", "passwd", "secret", "token", "api_key", "apikey")
    while i < len(text):
        name = next((n for n in names if text[i : i + len(n)].lower() == n and text[i : i + len(n)].isascii()), None)
        end = None
        if name:
            j = i + len(name)
            j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in (":", "=") and text[j : j + 1]:
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
                k = j
                while k < len(text) and text[k] in WORD:
                    k += 1
                if k > j:
                    end = k
                    if k - j >= 8:
                        found.append(("assign", i, k))
        i = end or i + 1
    for kind, start, inside, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), ("hex", "", "0123456789abcdef", 32)):
        i = 0
        while i < len(text):
            k = i + len(start)
            while text.startswith(start, i) and k < len(text) and text[k] in inside:
                k += 1
            if text.startswith(start, i) and k > i + len(start):
                if k - i >= least:
                    found.append((kind, i, k))
                i = k
            else:
                i += 1
    return sorted(found, key=lambda f: (f[1], secrets.KINDS.index(f[0])))


PARTS = ["password", "PassWD", "secret", "token", "api_key", "apikey", "API_KEY", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "deadbeef", " ", "  ", "=", ":", '"', "'", "x", "é", "ſecret", "hunter2hunter2", "A1", "-", "/", "\n", "toKen"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_patterns_equal_a_scan_by_hand(text):
    assert [f for f in secrets.find_secrets(text) if f[0] in ("assign", "access", "hex")] == scanned_base(text)


def test_base_patterns_of_the_query_equal_a_scan_by_hand(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in secrets.op9_secrets(spark, "/root/testdata/sf0.01").collect():
        found = scanned_base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(f[0] == k for f in found) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()


def test_allow_list_drops_spans_and_not_what_stands_beside_them():
    key = "q8Zr3TmX0vLk9WcY2bNh7JfP"
    for text in (f"{key}xxxxxxxx", f"/ab/{key}", f"550e8400-e29b-41d4-a716-446655440000-{key}", f"0123456789{key}"):
        found = [(k, text[s:e]) for k, s, e in secrets.find_secrets(text)]
        assert len(found) == 1 and key in found[0][1], text
    for clean in (f"example{key}", "550e8400-e29b-41d4-a716-446655440000", f"sha256-{key}", "/usr/local/lib/some-module/file_name", "x" * 60):
        assert secrets.find_secrets(clean) == []


def test_many_secrets_take_time_in_proportion():
    import time

    def seconds(lines):
        text = "\n".join(f"line {i} token=abcdef{i:08d} {'0123456789abcdef' * 2} {'q8Zr3TmX0vLk9WcY2bNh7JfP'}" for i in range(lines))
        began = time.perf_counter()
        assert len(secrets.find_secrets(text)) >= 3 * lines
        return time.perf_counter() - began

    seconds(200)
    assert seconds(16_000) < 24 * max(seconds(2000), 0.02)


def test_scan_covers_every_row(docs):
    assert secrets.scan_secrets(docs).count() == len(ROWS)


def test_scores_tell_held_out_documents_apart(spark):
    good, bad = WORDS[:60], WORDS[60:]
    rows = [(i, " ".join(RNG.choices(good if i % 2 else bad, k=60)), "x") for i in range(400)] + [(1000, None, "x"), (1001, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, target string")
    targets = spark.createDataFrame([(i,) for i in range(1, 200, 2)] + [(1,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in lm_score.score_documents(frame, targets, public_tokenizers.path("byte_bpe_50k.json"), 50257, 50256).collect()}
    assert got[1000].n_tokens == got[1001].n_tokens == 0 and got[1000].score is None
    held = [(got[i].score, i % 2) for i in range(200, 400)]
    assert max(s for s, y in held if y) < min(s for s, y in held if not y)
    assert abs(np.mean([got[i].score for i in range(1, 200, 2)]) - np.mean([s for s, y in held if y])) < 0.3


def test_scores_come_from_exact_counts(spark, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 5000, raising=False)
    monkeypatch.setattr(lm_score, "PART_TOKENS", 700, raising=False)
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(rng.randint(0, 90)))) for i in range(500)] + [(3, "twice"), (None, "no id")]
    chosen = set(range(0, 500, 7)) | {3}
    targets = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm_score.score_documents(frame, targets, public_tokenizers.path("byte_bpe_50k.json"), 50257, 50256).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = [(i, [*t.encode(text, add_special_tokens=False).ids, 50256]) for i, text in rows]
    pairs = lambda ids: list(zip([ids[-1], *ids[:-1]], ids, strict=True))
    models = []
    for some in (chosen, None):
        own = [x for i, x in coded if some is None or i in some]
        models.append((Counter(v for x in own for v in x), Counter(p for x in own for p in pairs(x))))
    assert len(models[1][1]) > 20_000
    scale = models[0][0].total() / models[1][0].total()
    want = []
    for i, ids in coded:
        losses = []
        for (one, two), factor, counted in ((models[0], 1.0, i in chosen), (models[1], scale, True)):
            own_1, own_2 = (Counter(ids), Counter(pairs(ids))) if counted else (Counter(), Counter())
            single = lambda v: factor * (one[v] - own_1[v])  # noqa: B023, E731
            total = factor * (one.total() - own_1.total()) + lm_score.UNIGRAM_PRIOR
            p = [(factor * (two[a, b] - own_2[a, b]) + lm_score.BIGRAM_PRIOR * (single(b) + lm_score.UNIGRAM_PRIOR / 50257) / total) / (single(a) + lm_score.BIGRAM_PRIOR) for a, b in pairs(ids)]
            losses.append(-float(np.log2(p).mean()) if len(ids) > 1 else None)
        want.append((i, len(ids) - 1, *losses))
    key = lambda r: (r[0] is not None, r[0], r[1])
    for a, b in zip(sorted(want, key=key), sorted((tuple(r)[:4] for r in got), key=key), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9)


def test_probabilities_sum_to_one():
    rng, vocabulary = np.random.default_rng(3), 300
    ids = rng.integers(0, 40, 5000) ** 2 % vocabulary
    single = np.bincount(ids, minlength=vocabulary).astype(float)
    one = lm_score.unigram(single, np.float64(len(ids)), vocabulary)
    assert abs(one.sum() - 1) < 1e-9
    before = np.roll(ids, 1)
    for scale in (1.0, 0.07):
        for context in (int(ids[0]), int(ids[17]), vocabulary - 1):
            two = np.bincount(ids[before == context], minlength=vocabulary) * scale
            assert abs(lm_score.bigram(two, single[context] * scale, lm_score.unigram(single * scale, len(ids) * scale, vocabulary)).sum() - 1) < 1e-6


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_pieces(empty).count() == secrets.scan_secrets(empty).count() == ngram_join.ngram_join(empty).count() == repeats.remove_repeats(empty).count() == 0
    token_store.write_token_store(empty, common.shared_path(spark, "no-tokens"), public_tokenizers.path("word_bpe_49k.json"), 1)
    for stage in (quality.keep_good, dedup.drop_copies, ngram_join.drop_near_copies, mixing.mixed_documents):
        assert stage(empty.withColumn("source", F.lit("s"))).count() == 0
    assert lm_score.score_documents(empty, empty, public_tokenizers.path("byte_bpe_50k.json"), 50257, 50256).count() == 0


def test_pipeline_stages_hand_on_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.common.staged(stage(spark, docs, ""), name)
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and all(texts[r.doc_id] == r.text for r in docs.collect())
    assert before.count() > 50
    tokens = encoded_counts([r.text for r in before.collect()])
    assert docs.agg({"length": "sum"}).first()[0] == tokens


def encoded_counts(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return sum(len(e.ids) + 1 for e in t.encode_batch(texts, add_special_tokens=False))
