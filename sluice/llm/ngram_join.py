"""N-gram Jaccard join by chosen paths: sets are split on sampled shared tokens until buckets are small, in repeated runs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.graph import components, hot_keys, hot_share, spread_join
from sluice.llm import common
from sluice.llm.shingles import mixed, shingle_sets

#: Sampled tokens a set: coordinate j is the shingle that hash j puts first. Two sets agree in one as often as their Jaccard index.
SKETCH = 64
#: A bucket of up to LIMIT sets is compared in full; a larger one is split again, MAX_DEPTH times at most. One that is larger even then
#: is dense if it has DENSE of the sets that it was split from; sets of the others get more runs, which split DEEP times.
LIMIT, MAX_DEPTH, DEEP, DENSE = 64, 3, 5, 0.6
#: Sets of a dense cluster that are compared at once, against each other or another block, and their bytes.
BLOCK, BLOCK_BYTES = 512, 4 << 20
TARGET_RECALL = 0.999
#: Pairs that agree in fewer coordinates than 5 standard deviations below the threshold aren't looked at further.
SIGMAS = 5


def runs_needed(threshold: float, recall: float = TARGET_RECALL, depth: int = MAX_DEPTH) -> int:
    """Runs after which a pair at the threshold has shared a bucket with at least this probability, split `depth` times in each."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def _multipliers() -> np.ndarray:
    return mixed(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)


def sketch(own: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """For each hash the low half of the value of the set's first token by that hash, as 32-bit integers."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(own), 4096):
        np.minimum(least, (own[k : k + 4096, None] * multipliers).min(axis=0), out=least)
    return (mixed(least) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    multipliers = _multipliers()
    for batch in batches:
        digests, sketches = [], []
        for own in shingle_sets(batch.column("text")):
            digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            sketches.append(sketch(own, multipliers) if len(own) else None)
        columns = [*batch.columns[:3], pa.array(digests, pa.binary()), pa.array(sketches, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_file", "_row", "digest", "sketch"])
    pa.default_memory_pool().release_unused()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [own.tobytes() for own in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary()), pa.array(map(len, sets), pa.int64())], ["node", "tokens", "size"])


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of sorted distinct values."""
    shared = len(x) + len(y) - len(np.union1d(x, y))
    return shared / (len(x) + len(y) - shared)


def _verifying(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True)
            near = [jaccard(*(np.frombuffer(t.as_buffer(), dtype=np.uint64) for t in pair)) >= threshold for pair in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def linked_in_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the sets at `left` (rows) and at `right` (columns) have a Jaccard index of at least the threshold."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    values, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    width, shared = int((n > 1).sum()), np.zeros((len(left), len(right)), dtype=np.float64)
    owner, used = np.repeat(np.arange(len(sets)), sizes.astype(int)), (n > 1)[at]
    owner, at = owner[used], column[at[used]]
    for k in range(0, width, 2048):  # as products of 0/1 matrices, some tokens at a time
        some = (at >= k) & (at < k + 2048)
        matrix = np.zeros((len(sets), min(2048, width - k)), dtype=np.float32)
        matrix[owner[some], at[some] - k] = 1
        shared += matrix[left] @ matrix[right].T
    return shared >= threshold * (sizes[left][:, None] + sizes[right][None, :] - shared) - 1e-9


def _block_links(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (cluster, i, j, block, node, tokens) sorted by the first three: node, its links in this pair of blocks, and a node it is linked with."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        i, j = rows[0][1], rows[0][2]
        blocks = np.array([r[3] for r in rows])
        nodes, sets = np.array([r[4] for r in rows], dtype=np.int64), [np.frombuffer(r[5], dtype=np.uint64) for r in rows]
        left, right = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        near = linked_in_block(sets, left, right, threshold)
        if i == j:
            np.fill_diagonal(near, False)
        links = np.zeros(len(rows), dtype=np.int64)
        links[left] += near.sum(axis=1)
        if i != j:
            links[right] += near.sum(axis=0)
        root = np.arange(len(rows))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(*np.nonzero(near), strict=True):
            a, b = find(left[x]), find(right[y])
            root[max(a, b)] = min(a, b)
        roots = nodes[[find(x) for x in range(len(rows))]]
        kept = links > 0
        return pa.RecordBatch.from_arrays([pa.array(nodes[kept]), pa.array(links[kept]), pa.array(roots[kept])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "block", "node", "tokens")), strict=True):
                if row[:3] != key and rows:
                    yield solve(rows)
                    rows = []
                key = row[:3]
                rows.append(row)
        if rows:
            yield solve(rows)
        pa.default_memory_pool().release_unused()

    return run


def _step(path: Column, depth: int, sketch: str | Column = "sketch") -> Column:
    """The path one level down: its hash picks the coordinate whose token parts the bucket's sets."""
    return F.xxhash64(path, F.get(sketch, F.pmod(F.xxhash64(path, F.lit(depth)), F.lit(SKETCH)).cast("int")), F.lit(depth))


def _sized(level: DataFrame) -> DataFrame:
    """(path, node, n) of the buckets with n sets, two at least; a bucket of very many doesn't come to one task."""
    sizes = level.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
    return spread_join(level, "path", sizes, "path", "n", hot_keys(level, "path"), "n").filter("n IS NOT NULL")


def _over_full(level: DataFrame) -> DataFrame | None:
    large = level.filter(F.col("n") > LIMIT)
    return None if large.isEmpty() else large


def _starts(first: int, runs: int) -> Column:
    """The paths of a set's runs, numbered from `first`, at depth 1: a coordinate each."""
    order = np.random.default_rng(7).permutation(SKETCH).tolist()
    return F.array(*[F.xxhash64(F.lit(r), F.get("sketch", F.lit(order[r % SKETCH])), F.lit(0)) for r in range(first, first + runs)])


def _buckets(sets: DataFrame, threshold: float, recall: float) -> tuple[list[DataFrame], DataFrame | None]:
    """(buckets of up to LIMIT sets, over-full buckets of sets that are near each other), each as (path, node, n)."""
    runs = runs_needed(threshold, recall)
    level = sets.select(F.explode(_starts(0, runs)).alias("path"), "node", F.lit(None).cast("long").alias("parent"))
    small, large = [], None
    for depth in range(1, MAX_DEPTH + 1):
        level = common.staged(_sized(level), "join-level")
        small.append(level.filter(F.col("n") <= LIMIT).select("path", "node", "n"))
        large = _over_full(level)
        if large is None:
            return small, None
        if depth < MAX_DEPTH:
            # a set's paths together, so that its sketch is brought once and not once a run
            own = large.groupBy("node").agg(F.collect_list(F.struct("path", "n")).alias("_paths"))
            near = own.join(sets.select(F.col("node").alias("_n"), "sketch"), own["node"] == F.col("_n"))
            level = near.select("node", "sketch", F.explode("_paths").alias("_p"))
            level = level.select(_step(F.col("_p.path"), depth).alias("path"), "node", F.col("_p.n").alias("parent"))
    # a bucket that its last split left nearly whole is dense: its sets share most tokens, and more splits would part what is linked
    dense = large.filter(F.col("n") >= DENSE * F.coalesce("parent", "n")).select("path", "node", "n")
    sparse = large.filter(F.col("n") < DENSE * F.coalesce("parent", "n"))
    crowd = common.staged(sets.join(sparse.select(F.col("node").alias("_n")).distinct(), sets["node"] == F.col("_n"), "left_semi").select("node", "sketch"), "join-crowd")
    if crowd.isEmpty():
        return small, dense
    # the others go straight down, in more runs
    level = crowd.select(F.explode(_starts(runs, runs_needed(threshold, recall, DEEP))).alias("path"), "node", "sketch")
    for depth in range(1, DEEP):
        level = level.withColumn("path", _step(F.col("path"), depth))
    level = common.staged(_sized(level.select("path", "node")), "join-deep")
    small.append(level.filter(F.col("n") <= LIMIT))
    return small, _over_full(dense.unionByName(level))


def ngram_join(docs: DataFrame, threshold: float = 0.8, recall: float = TARGET_RECALL) -> DataFrame:
    """A row for each row of docs: _file, _row, doc_id, class_id, n_links.

    Documents are linked if the Jaccard index of their sets of five-word shingles (shingles.shingle_sets) is at least the
    threshold. class_id is the least doc_id of those that links connect; n_links counts the other distinct sets that the
    join links a document's set with. Documents with equal sets are copies: they are one set here, in one class, and copies
    are no links. Texts without words have no shingles; each is its own class. Null doc_ids count as larger than any other.

    Sets are split on sampled shared tokens: a path picks one of SKETCH hashes, and the sets in its bucket go on by the token
    that this hash puts first, which two sets share with the probability of their index. Buckets of one end; those of up to
    LIMIT are compared in full; larger ones are split again. Runs with other hashes are repeated until a pair at the
    threshold has met in a bucket with the target recall. Of the buckets that are larger even at MAX_DEPTH, those that a split
    leaves nearly whole are dense, sets near each other; sets of the others get more runs, which split DEEP times, as many as
    keep the recall. Dense buckets, and what is over-full even then, form clusters, in which every link counts: their sets are
    compared with each other block by block, each pair of blocks in its own task, which returns link counts and a spanning
    forest and not the pairs. Blocks are bounded by sets and bytes; a cluster's work grows with the pairs in it. Pairs of
    small buckets lose those whose sketches differ by more than chance allows; the rest are decided by their whole sets.

    A text of any length is one set; null and empty texts and an empty table give no links. Rows that repeat are copies.
    """
    with common.scratch(docs.sparkSession), common.small_batches(docs.sparkSession, 1000):
        return common.staged(_labelled(docs, threshold, recall).drop("label"), "join-classes", keep=True)


def _labelled(docs: DataFrame, threshold: float = 0.8, recall: float = TARGET_RECALL) -> DataFrame:
    """ngram_join's rows with `label`, one number for each class whatever its doc_ids, null for texts without words."""
    placed = common.with_locator(docs, "doc_id", "text")
    rows = placed.select(placed["doc_id"].cast("long").alias("doc_id"), "_file", "_row", placed["text"].alias("text"))
    coded = common.staged(rows.mapInArrow(_sketching, "doc_id long, _file string, _row long, digest binary, sketch array<int>"), "join-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_file", "_row"))
    sets = coded.filter("digest IS NOT NULL").groupBy("digest").agg(first.alias("first"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    sets = common.staged(sets.withColumn("node", F.monotonically_increasing_id()), "join-sets")
    small, large = _buckets(sets, threshold, recall)

    # small buckets: pairs, each once
    members = [s.groupBy("path").agg(F.sort_array(F.collect_list("node")).alias("m")) for s in small]
    inner = lambda x, i: F.transform(F.slice("m", i + 2, F.lit(LIMIT)), lambda y: F.struct(x.alias("a"), y.alias("b")))
    pairs = None
    for m in members:
        some = m.select(F.explode(F.flatten(F.transform("m", inner))).alias("p")).select("p.a", "p.b")
        pairs = some if pairs is None else pairs.union(some)
    pairs = pairs.distinct()

    # clusters of what large buckets share
    clusters = None
    if large is not None:
        pivots = large.groupBy("path").agg(F.min("node").alias("pivot"))
        spokes = spread_join(large, "path", pivots, "path", "pivot", hot_keys(large, "path"), "pivot")
        clusters = components(spokes.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
        own = lambda c: clusters.select(F.col("node").alias(f"_n{c}"), F.col("label").alias(f"_c{c}"))
        a, b = own("a"), own("b")
        pairs = pairs.join(a, pairs["a"] == a["_na"], "left").join(b, F.col("b") == b["_nb"], "left")
        pairs = pairs.filter(~F.coalesce(F.col("_ca") == F.col("_cb"), F.lit(False))).select("a", "b")

    # what the sketches leave
    least = math.floor(SKETCH * (threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / SKETCH)))
    left, right = (sets.select(F.col("node").alias(f"_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    both = pairs.join(left, pairs["a"] == left["_a"]).join(right, F.col("b") == right["_b"])
    agreed = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    pairs = common.staged(both.filter(agreed >= least).select("a", "b"), "join-pairs")

    # whole sets of those still needed, from their texts
    needed = pairs.select(F.col("a").alias("need")).union(pairs.select("b"))
    if clusters is not None:
        needed = needed.union(clusters.select("node"))
    needed = sets.join(needed.distinct(), sets["node"] == F.col("need"), "left_semi").select("node", F.col("first._file").alias("_f"), F.col("first._row").alias("_r"))
    needed = common.staged(needed, "join-needed")
    needed = common.bounded_broadcast(needed)
    texts = placed.select("_file", "_row", placed["text"].alias("text")).join(needed, (F.col("_file") == needed["_f"]) & (F.col("_row") == needed["_r"])).select("node", "text")
    tokens = common.staged(texts.mapInArrow(_sets, "node long, tokens binary, size long"), "join-tokens")

    left, right = (tokens.select(F.col("node").alias(f"_{c}"), F.col("tokens").alias(f"tokens_{c}")) for c in "ab")
    links = pairs.join(left, pairs["a"] == left["_a"]).join(right, F.col("b") == right["_b"]).select("a", "b", "tokens_a", "tokens_b")
    links = common.staged(links.mapInArrow(_verifying(threshold), "a long, b long"), "join-links")
    degrees = links.select(F.col("a").alias("node"), F.lit(1).cast("long").alias("links")).union(links.select("b", F.lit(1).cast("long")))
    edges = links
    if clusters is not None:
        sized = clusters.join(tokens.select(F.col("node").alias("_n"), "size"), clusters["node"] == F.col("_n"))
        most = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int")
        blocks = sized.groupBy("label").agg(most.alias("blocks"))
        dealt = spread_join(clusters, "label", blocks, "label", "blocks", hot_keys(clusters, "label"), "blocks")
        dealt = dealt.select(F.col("label").alias("cluster"), "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("cluster", "block", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        full = dealt.join(tokens.withColumnRenamed("node", "_n"), dealt["node"] == F.col("_n")).select("cluster", "i", "j", "block", "node", "tokens")
        full = full.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
        found = common.staged(full.mapInArrow(_block_links(threshold), "node long, links long, root long"), "join-blocks")
        degrees = degrees.union(found.select("node", "links"))
        edges = edges.union(found.select("node", "root"))
    degrees = degrees.groupBy(F.col("node").alias("_d")).agg(F.sum("links").alias("links"))
    labels = components(edges).withColumnRenamed("node", "_l")

    # classes
    known = sets.join(labels, sets["node"] == labels["_l"], "left").join(degrees, F.col("node") == degrees["_d"], "left")
    known = known.select("digest", "copies", F.col("first.doc_id").alias("least"), F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    known = common.staged(known, "join-known")
    classes = known.groupBy("label").agg(F.min("least").alias("class_id"))
    known = spread_join(known, "label", classes, "label", "class_id", hot_keys(known, "label"), "class_id")
    known = known.select("digest", F.struct("label", "class_id", "n_links").alias("of"))
    total = coded.count()
    hot = sets.filter(F.col("copies") * hot_share(docs.sparkSession) > total).select(F.col("digest").alias("_hot"))
    joined = spread_join(coded.drop("sketch"), "digest", known, "digest", "of", hot, "of")
    class_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("of.class_id"))
    return joined.select("_file", "_row", "doc_id", class_id.alias("class_id"), F.coalesce("of.n_links", F.lit(0)).cast("long").alias("n_links"), "of.label")


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, recall: float = TARGET_RECALL) -> DataFrame:
    """One row of each class of ngram_join, all columns: the one with the class's least doc_id, the first in the files of these.

    Classes are told apart by their links, not by their doc_ids, which may come twice or be null. Null texts and texts without
    words all stay; of rows that repeat one stays; texts of any length are one set. An empty table stays empty.
    """
    docs = common.filed(docs)
    placed = common.with_locator(docs)
    with common.scratch(docs.sparkSession), common.small_batches(docs.sparkSession, 1000):
        classes = common.staged(_labelled(docs, threshold, recall).filter("label IS NOT NULL"), "join-classes")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_file", "_row"))
        keepers = classes.groupBy("label").agg(first.alias("keep"))
        joined = spread_join(classes, "label", keepers, "label", "keep", hot_keys(classes, "label"), "keep")
        dropped = joined.filter(~((F.col("_file") == F.col("keep._file")) & (F.col("_row") == F.col("keep._row"))))
        dropped = common.staged(dropped.select(F.col("_file").alias("_f"), F.col("_row").alias("_r")), "join-dropped", keep=True)
    dropped = common.bounded_broadcast(dropped)
    return placed.join(dropped, (placed["_file"] == dropped["_f"]) & (placed["_row"] == dropped["_r"]), "left_anti").select("_doc.*")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(common.documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")
