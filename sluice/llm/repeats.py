"""Long repeats across all documents, found with run-compressed indexes of the places where texts could be equal."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common
from sluice.llm.run_index import repeated_spans

#: Bytes of a repeat, and of an anchor.
LENGTH, ANCHOR = 200, 48
#: What a repeat that holds an anchor has besides it.
REST = LENGTH - ANCHOR
#: Contexts that are indexed together; larger groups are parted by what stands beside the anchor.
GROUP = 16_384
#: Starts of strings that are looked at together in a long text; a power of two.
STRETCH = 1 << 23
#: Bytes of contexts in one index.
BLOCK_BYTES = 1 << 20


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's anchors the places, the hashes, and the first and last start of the LENGTH-byte strings that have them as theirs.

    The anchor of a string of LENGTH bytes is the ANCHOR-byte string in it with the least hash, the leftmost of equal ones;
    so equal strings have it at the same place. Hashes of 1, 2, 4 ... bytes are combined to those of ANCHOR bytes, and least
    values of 1, 2, 4 ... places to those of a whole string, over a stretch of text at once.
    """
    found = []
    for k in range(0, max(0, len(text) - LENGTH + 1), STRETCH):
        at, h, first, last = _anchors(text[k : k + STRETCH + LENGTH - 1])
        found.append((at + k, h, first + k, last + k))
    if not found:
        return (*(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64)),)
    return (*(np.concatenate(c) for c in zip(*found, strict=True)),)


def _anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(text)
    h, factor, width = text.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    parts = {}
    while width <= ANCHOR:
        parts[width] = h
        if 2 * width > ANCHOR:
            break
        h = (h[:-width] * np.uint64(factor)) ^ (h[width:] + (h[:-width] >> np.uint64(29)))
        factor, width = (factor * 0xBF58476D1CE4E5B9 | 1) % 2**64, 2 * width
    rest = ANCHOR - width
    while rest:
        part = max(p for p in parts if p <= rest)
        h = (h[: n - (ANCHOR - rest) - part + 1] * np.uint64(0x94D049BB133111EB)) ^ parts[part][ANCHOR - rest :][: n - (ANCHOR - rest) - part + 1]
        rest -= part
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    place = np.uint64(2 * STRETCH - 1)
    least = _sliding(h & ~place | np.arange(len(h), dtype=np.uint64), REST + 1, np.minimum) & place
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    at = least[first].astype(np.int64)
    return at, h[at], first, np.concatenate([first[1:] - 1, [len(least) - 1]])


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every `width` values in a row."""
    have = 1
    while 2 * have <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def _anchoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, rows = batch.column("file").to_numpy(), batch.column("row").to_numpy()
        found = [anchors(np.frombuffer(t.as_buffer(), dtype=np.uint8)) for t in batch.column("text")]
        n = [len(f[0]) for f in found]
        if sum(n):
            at, h, first, last = (np.concatenate([f[k] for f in found]) for k in range(4))
            columns = [h.view(np.int64), np.repeat(files, n), np.repeat(rows, n), at, (at - first).astype(np.int16), (at - last).astype(np.int16)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "file", "row", "at", "first", "last"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each anchor of (file, row, text, hits): the 128-bit hash of its context and the context's place."""
    names = ["c1", "c2", "anchor", "file", "row", "left", "length", "at"]
    for batch in batches:
        texts, hits = batch.column("text"), batch.column("hits")
        flat = hits.flatten()
        at, first, last = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "first", "last"))
        n = np.diff(hits.offsets.to_numpy())
        lefts, rights = at - first, at - last + LENGTH
        digests, k = [], 0
        for text, own in zip(texts, n, strict=True):
            view = memoryview(text.as_buffer())
            ends = zip(lefts[k : k + own].tolist(), rights[k : k + own].tolist(), first[k : k + own].tolist(), strict=True)
            digests += [xxhash.xxh3_128_digest(view[a:b], seed=f) for a, b, f in ends]
            k += own
        c = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        columns = [c[:, 0], c[:, 1], flat.field("anchor"), np.repeat(batch.column("file").to_numpy(), n), np.repeat(batch.column("row").to_numpy(), n), lefts, rights - lefts, at]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def _context_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
            view = memoryview(text.as_buffer())
            for w in wanted:
                rows.append((w["c1"], w["c2"], w["anchor"], w["n"], w["at"] - w["left"], bytes(view[w["left"] : w["left"] + w["length"]])))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        types = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["c1", "c2", "key", "n", "offset", "context"])


def _indexing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the contexts that came once, of rows sorted by key; whole groups are indexed together, some in one index."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        spans = repeated_spans([r[5] for r in rows], [r[4] for r in rows], LENGTH)
        found = [(r[0], r[1], s, e) for r, own in zip(rows, spans, strict=True) if r[3] == 1 for s, e in own]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * 4)], ["c1", "c2", "start", "end"])

    block: list[tuple] = []
    seen: set[tuple[int, int]] = set()
    held = 0

    def groups() -> Iterator[list[tuple]]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "key", "n", "offset", "context")), strict=True):
                if group and row[2] != group[-1][2]:
                    yield group
                    group = []
                group.append(row)
        if group:
            yield group

    for group in groups():
        own = {row[:2] for row in group}
        if held >= BLOCK_BYTES or not seen.isdisjoint(own):  # a context of two groups would repeat itself
            yield solve(block)
            block, seen, held = [], set(), 0
        block += group
        seen |= own
        held += sum(len(row[5]) for row in group)
    if block:
        yield solve(block)


def _cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for file, row, text, spans in zip(batch.column("file").to_pylist(), batch.column("row").to_pylist(), batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            view = memoryview(text.as_buffer())
            merged: list[list[int]] = []
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            kept, last = hashlib.sha256(), 0
            for s, e in merged:
                kept.update(view[last:s])
                last = e
            kept.update(view[last:])
            out.append((file, row, merged, kept.hexdigest()))
        types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, types, strict=True)], ["file", "row", "removed", "kept_sha256"])


def _split_groups(contexts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows to index by key, spans found on the way) of (c1, c2, key, n, offset, context).

    A group of more than GROUP contexts, such as those of a line that very many texts have, is parted: a repeat that holds the
    anchor has half of its other bytes or more on one side of it, so two equal ones meet in the group of those whose nearest
    bytes on that side are equal. Each side's half is taken in turn, until groups are small or the whole repeat is spelt out;
    what is over-full even then is grouped by the bytes of the repeat itself, LENGTH of them, partial counts first, and strings
    that come twice are repeats. No context is left out, and none comes to a task with all others.
    """
    ready, spans, rest = [], None, REST
    level = contexts.withColumns({"a": F.lit(0), "b": F.lit(0), "root": F.col("key")})
    while True:
        sizes = level.groupBy("key").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("alone")).filter("m > 1 AND alone > 0").withColumnRenamed("key", "_k")
        sizes = common.staged(sizes, "repeats-sizes")
        level = common.staged(level.join(sizes, level["key"] == sizes["_k"]).select(*level.columns, "m"), "repeats-groups")
        ready.append(level.filter(F.col("m") <= GROUP))
        level = level.filter(F.col("m") > GROUP).drop("m")
        if level.isEmpty():
            break
        half = (rest + 1) // 2
        begin = F.col("offset") - F.col("a") - half
        right = F.col("offset") + ANCHOR + F.col("b")
        sides = []
        for side, there, piece, grown in (("L", begin >= 0, F.substring("context", begin + 1, F.lit(half)), "a"), ("R", F.length("context") - right >= half, F.substring("context", right + 1, F.lit(half)), "b")):
            sides.append(level.filter(there).withColumn("key", F.xxhash64("key", F.lit(side), piece)).withColumn(grown, F.col(grown) + half))
        level, rest = sides[0].unionByName(sides[1]), rest - half
        if rest == 0:
            start = (F.col("offset") - F.col("a")).cast("long")
            whole = F.substring("context", (start + 1).cast("int"), F.lit(LENGTH))
            level = level.select("c1", "c2", "n", "root", start.alias("start"), whole.alias("whole")).distinct()  # one place may be spelt out in two ways
            sizes = level.groupBy("root", "whole").agg(F.count("*").alias("m")).filter("m > 1").select(F.col("root").alias("_r"), F.col("whole").alias("_w"))
            again = level.join(sizes, (level["root"] == sizes["_r"]) & (level["whole"] == sizes["_w"])).filter("n = 1")
            spans = again.select("c1", "c2", "start", (F.col("start") + LENGTH).alias("end"))
            break
    rows = ready[0]
    for r in ready[1:]:
        rows = rows.union(r)
    return rows.select("c1", "c2", "key", "n", "offset", "context"), spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n_bytes, removed (an array of [start, end) of bytes), kept_sha256.

    Removed is each byte that a string of LENGTH bytes covers which also starts anywhere else, in the same text or another;
    strings do not cross texts, and are judged on the input. A null text is empty; one shorter than LENGTH loses nothing.
    Columns besides doc_id and text are not read. Rows that repeat are copies of each other and lose all their bytes; an
    empty table gives no rows.

    1. Copies of a text are set aside by their SHA-256; each group is looked at as one text and loses everything itself.
    2. Anchors are chosen by content in every text, so that equal strings share one. Their hashes are counted over all texts,
       partial counts first; only anchors that come twice go on.
    3. Each of these has a context, what the strings that have the anchor as theirs cover. Contexts that are equal, by 128 bits
       of hash, are repeats from end to end. Of the groups in which contexts of one anchor differ, the contexts' bytes go to
       tasks by anchor, and are indexed there (run_index): positions whose matching statistics reach LENGTH begin a repeat.
       Over-full groups are parted further first (_split_groups).
    4. The spans of all contexts are brought back to their texts, merged and cut.
    """
    spark = docs.sparkSession
    docs = common.filed(docs)
    with common.scratch(spark), common.small_batches(spark):
        return common.staged(_removed(docs), "repeats", keep=True)


def _removed(docs: DataFrame) -> DataFrame:
    placed = common.with_locator(docs, "doc_id", "text")
    body = F.coalesce(placed["text"], F.lit("")).cast("binary")
    rows = placed.select(placed["doc_id"].cast("long").alias("doc_id"), F.xxhash64("_file").alias("file"), F.col("_row").alias("row"), body.alias("text"))
    plain = common.staged(rows.select("doc_id", "file", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "repeats-texts")

    copies = plain.filter(F.col("n_bytes") >= LENGTH).groupBy("sha").agg(F.count("*").alias("n"), F.min(F.struct("file", "row")).alias("first")).filter("n > 1")
    copies = common.staged(copies, "repeats-copies").withColumnRenamed("sha", "_s")
    copied = common.bounded_broadcast(copies)
    is_first = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    others = common.staged(plain.join(copied, plain["sha"] == copied["_s"]).filter(~is_first).select(F.col("file").alias("_f"), F.col("row").alias("_r")), "repeats-others")
    others = common.bounded_broadcast(others)
    texts = rows.filter(F.octet_length("text") >= LENGTH).join(others, (rows["file"] == others["_f"]) & (rows["row"] == others["_r"]), "left_anti").select("file", "row", "text")

    found = common.staged(texts.mapInArrow(_anchoring, "anchor long, file long, row long, at long, first short, last short"), "repeats-anchors")
    # counts are staged before they are joined: both sides of the join are then plain shuffles, whose hot anchors Spark can split
    again = common.staged(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("anchor").alias("_a")), "repeats-again")
    hits = common.staged(found.join(again, found["anchor"] == again["_a"], "left_semi"), "repeats-hits")
    by_text = common.staged(hits.groupBy(F.col("file").alias("_f"), F.col("row").alias("_r")).agg(F.collect_list(F.struct("at", "anchor", "first", "last")).alias("hits")), "repeats-hits-by-text")
    wanted = common.bounded_broadcast(by_text.select(F.col("_f").alias("_wf"), F.col("_r").alias("_wr")))
    held = texts.join(wanted, (texts["file"] == wanted["_wf"]) & (texts["row"] == wanted["_wr"]), "left_semi")
    held = common.staged(held.join(by_text, (held["file"] == by_text["_f"]) & (held["row"] == by_text["_r"])).select("file", "row", "text", "hits"), "repeats-held")

    places = "c1 long, c2 long, anchor long, file long, row long, left long, length long, at long"
    placed_contexts = common.staged(held.mapInArrow(_contexts, places), "repeats-contexts")
    distinct = placed_contexts.groupBy("c1", "c2", "anchor").agg(F.count("*").alias("n"), F.min(F.struct("file", "row", "left", "length", "at")).alias("first"))
    distinct = common.staged(distinct, "repeats-distinct")
    differing = distinct.groupBy("anchor").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("alone")).filter("m > 1 AND alone > 0").select(F.col("anchor").alias("_a"))
    differing = common.staged(differing, "repeats-differing")
    needed = distinct.join(differing, distinct["anchor"] == differing["_a"], "left_semi")
    needed = needed.groupBy(F.col("first.file").alias("_f"), F.col("first.row").alias("_r")).agg(F.collect_list(F.struct("c1", "c2", "anchor", "n", F.col("first.at").alias("at"), F.col("first.left").alias("left"), F.col("first.length").alias("length"))).alias("wanted"))
    contexts = held.select("file", "row", "text").join(needed, (held["file"] == needed["_f"]) & (held["row"] == needed["_r"])).select("text", "wanted")
    contexts = common.staged(contexts.mapInArrow(_context_texts, "c1 long, c2 long, key long, n long, offset int, context binary"), "repeats-context-texts")
    to_index, spelt = _split_groups(contexts)
    spans = to_index.repartition("key").sortWithinPartitions("key").mapInArrow(_indexing, "c1 long, c2 long, start long, end long")
    if spelt is not None:
        spans = spans.union(spelt)
    spans = spans.groupBy(F.col("c1").alias("_1"), F.col("c2").alias("_2")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    counted = distinct.filter("n > 1").select(F.col("c1").alias("_1"), F.col("c2").alias("_2"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))).alias("spans"))
    verdicts = common.staged(spans.union(counted), "repeats-verdicts")
    covered = placed_contexts.join(verdicts, (placed_contexts["c1"] == verdicts["_1"]) & (placed_contexts["c2"] == verdicts["_2"]))
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("left")).alias("start"), (F.coalesce(s["end"], F.col("length")) + F.col("left")).alias("end")))
    covered = covered.groupBy(F.col("file").alias("_f"), F.col("row").alias("_r")).agg(F.flatten(F.collect_list(moved)).alias("spans"))
    cut = held.select("file", "row", "text").join(covered, (held["file"] == covered["_f"]) & (held["row"] == covered["_r"])).select("file", "row", "text", "spans")
    cut = common.staged(cut.mapInArrow(_cutting, "file long, row long, removed array<array<long>>, kept_sha256 string"), "repeats-cut")

    cut = cut.withColumnsRenamed({"file": "_f", "row": "_r", "kept_sha256": "cut_sha"})
    joined = plain.join(copied, plain["sha"] == copied["_s"], "left").join(cut, (plain["file"] == cut["_f"]) & (plain["row"] == cut["_r"]), "left")
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    removed = F.when(F.col("_s").isNotNull(), whole).otherwise(F.coalesce("removed", F.array().cast("array<array<bigint>>")))
    kept = F.when(F.col("_s").isNotNull(), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha"))
    return joined.select("doc_id", "n_bytes", removed.alias("removed"), kept.alias("kept_sha256"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(common.documents(spark, sf_dir))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r[1] - r[0])
    return rows.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
