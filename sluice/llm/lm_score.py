"""Cross-entropy difference: matched target and background bigram models over one vocabulary, and per-token loss differences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import common, tokens

#: Ids are held in 16 bits, so a vocabulary has 65,536 at most; a pair's key is both ids side by side, a single token's has this bit besides.
SINGLE = 1 << 32
#: A block, whose documents are counted and scored together, ends with the document that takes it to so many tokens.
BLOCK_TOKENS = 1 << 21
#: Tokens whose own counts are taken together, about.
PART_TOKENS = 1 << 18
#: Weight of the unigram model in a bigram's, and of one count spread over the vocabulary in a unigram's, in tokens.
BIGRAM_PRIOR, UNIGRAM_PRIOR = 50.0, 1000.0
IDS = "block long, doc_id long, target boolean, n_ids long, ids binary"
COUNTS = "block long, key long, target long, background long"
SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double"


def _encoding(file: str, end_id: int, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(file, False)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in _slices(batches, tokens.ROWS):
            ids, bounds = encode(batch.column("text"), end_id)
            sizes, blocks = np.diff(bounds), []
            for n in sizes.tolist():
                blocks.append(block)
                held += n
                if held >= block_tokens:
                    block, held = block + 1, 0
            offsets = pa.py_buffer((bounds * 2).astype(np.int32))
            binary = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype("<u2"))])
            columns = [pa.array(blocks, pa.int64()), batch.column("doc_id"), batch.column("target"), pa.array(sizes.astype(np.int64)), binary]
            yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "target", "n_ids", "ids"])

    return run


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of fewer documents: arrays over all ids of a batch are several times its size."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _ids(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column, and where each document's start and the last end; the last id of each is the end id."""
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1] // 2
    return np.frombuffer(column.buffers()[2], dtype="<u2")[bounds[0] : bounds[-1]].astype(np.int64), (bounds - bounds[0]).astype(np.int64)


def bigram_keys(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the token before each one (before a document's first its last, the end id), and the key of the pair."""
    before = np.arange(len(ids)) - 1
    some = np.diff(bounds) > 0
    before[bounds[:-1][some]] = bounds[1:][some] - 1
    return before, ids[before] << 16 | ids


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the keys of each block's tokens and pairs, among target documents and among all, as rows."""
    block, held = None, []
    for batch in _slices(batches):
        ids, bounds = _ids(batch.column("ids"))
        _, pairs = bigram_keys(ids, bounds)
        blocks = batch.column("block").to_numpy()
        target = np.repeat(batch.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
        starts = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1))
        for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
            if blocks[a] != block:
                yield from _counted(block, held)
                block, held = int(blocks[a]), []
            at = slice(bounds[a], bounds[b])
            held.append((ids[at] | SINGLE, pairs[at], target[at]))
    yield from _counted(block, held)


def _counted(block: int | None, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for column in (0, 1):
        if not held:
            return
        keys, counts = np.unique(np.concatenate([h[column] for h in held]), return_counts=True)
        of_target = np.zeros(len(keys), dtype=np.int64)
        some, n = np.unique(np.concatenate([h[column][h[2]] for h in held]), return_counts=True)
        of_target[np.searchsorted(keys, some)] = n
        for k in range(0, len(keys), 1 << 16):
            at = slice(k, k + (1 << 16))
            columns = [pa.array(np.full(len(keys[at]), block)), pa.array(keys[at]), pa.array(of_target[at]), pa.array(counts[at])]
            yield pa.RecordBatch.from_arrays(columns, ["block", "key", "target", "background"])


def _own(x: np.ndarray, document: np.ndarray) -> np.ndarray:
    """How often each value comes in its document, in its places."""
    _, at, n = np.unique(document << 32 | x, return_inverse=True, return_counts=True)
    return n[at]


def train(coded: DataFrame) -> DataFrame:
    """block, key, target, background: for the keys of each block, their exact counts in all documents that are targets and in all documents.

    A block has one row for a key (two if its rows are read by two tasks), so a key of any number of occurrences has about
    as many rows as there are blocks it comes in.
    """
    counts = coded.select("block", "target", "ids").mapInArrow(_counting, COUNTS)
    same = Window.partitionBy("key")
    return counts.select("block", "key", F.sum("target").over(same).alias("target"), F.sum("background").over(same).alias("background"))


def unigram(single: np.ndarray, total: np.ndarray, vocabulary: int) -> np.ndarray:
    """Probability of tokens counted `single` times among `total`; over the vocabulary they sum to 1."""
    return (single + UNIGRAM_PRIOR / vocabulary) / (total + UNIGRAM_PRIOR)


def bigram(two: np.ndarray, context: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Probability of tokens counted `two` times after a token counted `context` times, `one` by themselves; over the vocabulary they sum to 1.

    Each occurrence of a token has one after it, since a document's end is followed by its start; so the counts after a
    context add up to the context's own.
    """
    return (two + BIGRAM_PRIOR * one) / (context + BIGRAM_PRIOR)


def _scoring(vocabulary: int, totals: tuple[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    scale = totals[0] / totals[1] if totals[0] and totals[1] else 1.0

    def losses(ids: np.ndarray, bounds: np.ndarray, is_target: np.ndarray, keys: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Sum of the losses of each document's tokens, in bits, by the target and the background model, without the document's own counts."""
        before, pairs = bigram_keys(ids, bounds)
        document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        one_at, two_at = np.searchsorted(keys, ids | SINGLE), np.searchsorted(keys, pairs)
        own_1, own_2 = _own(ids, document), _own(pairs, document)
        out = []
        for n, factor, counted, all_tokens in ((counts[0], 1.0, is_target[document], totals[0]), (counts[1], scale, True, totals[1])):
            less = factor * counted
            total = np.maximum(0.0, all_tokens * factor - less * np.diff(bounds)[document])
            single = np.maximum(0, n[one_at] * factor - less * own_1)
            one = unigram(single, total, vocabulary)
            two, context = np.maximum(0, n[two_at] * factor - less * own_2), single[before]
            out.append(np.add.reduceat(-np.log2(bigram(two, context, one)), bounds[:-1]))
        return out

    def run(docs: pa.Table, model: pa.Table) -> pa.Table:
        keys = model["key"].to_numpy()
        order = np.argsort(keys)
        keys, counts = keys[order], (model["target"].to_numpy()[order], model["background"].to_numpy()[order])
        sizes, is_target = docs["n_ids"].to_numpy(), docs["target"].to_numpy().astype(bool)
        part = (np.cumsum(sizes) - sizes) // PART_TOKENS
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        sums: tuple[list, list] = ([], [])
        for a, b in zip(starts, [*starts[1:], len(sizes)], strict=True):
            ids, bounds = _ids(docs["ids"].slice(a, b - a).combine_chunks())
            for held, own in zip(sums, losses(ids, bounds, is_target[a:b], keys, counts), strict=True):
                held.append(own)
        means = [pa.array(np.concatenate(s) / sizes, mask=sizes <= 1) for s in sums]
        return pa.Table.from_arrays([docs["doc_id"], pa.array(sizes - 1), *means], ["doc_id", "n_tokens", "target_loss", "background_loss"])

    return run


def score_documents(docs: DataFrame, targets: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for every row of docs.

    `targets` has the doc_ids of the target documents, such as those labelled as good; the background is all documents. Both
    models are interpolated bigram models over the tokenizer's vocabulary, with exact counts and the same priors, and the
    background's counts are scaled to the target's number of tokens, so that they are smoothed alike. score is the
    target's minus the background's loss in bits a token: below 0 reads more like the target. A document's own counts are
    taken out of the models that score it, so target documents have no advantage. Counts cover all whole texts. Null and
    empty texts have 0 tokens and null losses; without a target document, all scores come from the priors. Rows that repeat
    are counted and scored as often as they come; a doc_id may come more than once in targets. Other columns are not read.

    Blocks of documents meet the counts of just the keys they hold, so neither model is in one place; the driver gets two sums.
    """
    spark = docs.sparkSession
    with common.scratch(spark), common.small_batches(spark):
        chosen = common.staged(targets.select(targets["doc_id"].cast("long").alias("_t")).dropna().distinct(), "lm-targets")
        chosen = common.bounded_broadcast(chosen).withColumn("_is", F.lit(True))
        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
        rows = rows.join(chosen, rows["doc_id"] == chosen["_t"], "left").select("doc_id", F.coalesce("_is", F.lit(False)).alias("target"), "text")
        coded = common.staged(rows.mapInArrow(_encoding(tokenizer, end_id, BLOCK_TOKENS), IDS), "lm-ids")
        sums = coded.agg(F.sum(F.when(F.col("target"), F.col("n_ids"))), F.sum("n_ids")).first()
        score = _scoring(vocabulary, (sums[0] or 0, sums[1] or 0))
        scored = coded.groupBy("block").cogroup(train(coded).groupBy("block")).applyInArrow(score, SCORES)
        return common.staged(scored.withColumn("score", F.col("target_loss") - F.col("background_loss")), "lm-scores", keep=True)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0))
    return score_documents(common.documents(spark, sf_dir), good, public_tokenizers.path("byte_bpe_50k.json"), 50_257, 50_256)
