"""Importance resampling towards a target: hashed word n-grams of two corpora, gains by bucket, the best documents by a perturbed score."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.ranks import placed
from sluice.llm import common

BUCKETS, LONGEST, MIN_WORDS = 10_000, 3, 20
#: Words as bytes of UTF-8, with A-Z in lower case: digits, letters and all that isn't ASCII. A zero byte between texts is no part of a word.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SENTINEL = b"\x00"
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: By byte, whether it is part of a word.
IN_WORD = np.array([WORD.match(bytes([b])) is not None for b in range(256)])
#: Bytes of texts whose words are held at a time, about.
JOINED_BYTES = 2 << 20
#: Checksums of words that a task keeps.
KEPT_WORDS = 1 << 17


def _shift_tables() -> np.ndarray:
    """[k, i, b]: the checksum register with byte b at place i, after 2^k more bytes of zeros."""
    step = np.array([_crc_of_byte(b) for b in range(256)], dtype=np.uint32)
    one = np.zeros((4, 256), dtype=np.uint32)
    for i in range(4):
        register = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
        one[i] = step[register & 0xFF] ^ (register >> np.uint32(8))
    tables = [one]
    for _ in range(30):
        tables.append(_apply(tables[-1], tables[-1].reshape(-1)).reshape(4, 256))
    return np.array(tables)


def _crc_of_byte(b: int) -> int:
    for _ in range(8):
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return b


def _apply(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return table[0][register & 0xFF] ^ table[1][(register >> 8) & 0xFF] ^ table[2][(register >> 16) & 0xFF] ^ table[3][register >> 24]


SHIFTS = _shift_tables()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of strings put together, from the crc32 of both parts and the second part's bytes: the first is moved over the bits of the length."""
    out, k = first.copy(), 0
    while np.any(length >> k):
        on = np.flatnonzero((length >> k) & 1)
        out[on] = _apply(SHIFTS[k], out[on])
        k += 1
    return out ^ second


class Words(dict):
    """Places of words, given as they come; by place, the crc32 of the word, that of a space and the word, and the bytes of both."""

    def __init__(self) -> None:
        self.about = np.zeros((3, 1024), dtype=np.uint32)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at == self.about.shape[1]:
            self.about = np.concatenate([self.about, np.zeros_like(self.about)], axis=1)
        self.about[:, at] = zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KEPT_WORDS:
            self.__init__()
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return self.about[:, at]


def _pieces(joined: bytes) -> Iterator[tuple[int, int]]:
    """Where to cut, never within a word."""
    start = 0
    while start < len(joined):
        end = start + JOINED_BYTES
        gap = GAP.search(joined, end) if end < len(joined) else None
        end = gap.start() if gap else len(joined)
        yield start, end
        start = end


def features_of(texts: list[bytes], words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket of every feature; text of every word), a piece of the joined texts at a time.

    The texts are joined with a sentinel between them and one pass of WORD finds all words; where a word begins tells its
    text, by a binary search in the texts' offsets. An n-gram counts where it ends, if its words are of one text. A piece's last
    words are carried over, so texts of any length are held as words a part at a time and no n-gram is lost.
    """
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    joined = SENTINEL.join(texts).lower()
    before, text_before = np.zeros((3, 0), dtype=np.uint32), np.zeros(0, dtype=np.int64)
    for start, end in _pieces(joined):
        inside = IN_WORD[np.frombuffer(joined, dtype=np.uint8, count=end - start, offset=start)]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) + start
        text = np.concatenate([text_before, np.searchsorted(offsets, starts, side="right") - 1])
        about = np.concatenate([before, words.of(WORD.findall(joined, start, end))], axis=1)
        new = before.shape[1]
        crc, with_space, length = about
        owners, buckets = [text[new:]], [crc[new:] % BUCKETS]
        so_far = crc
        for n in range(2, LONGEST + 1):
            if len(crc) < n:
                break
            so_far = joined_crc(so_far[:-1], with_space[n - 1 :], length[n - 1 :])
            own = text[: -(n - 1)] == text[n - 1 :]
            own[: max(0, new - n + 1)] = False  # it ended in the piece before
            owners.append(text[n - 1 :][own])
            buckets.append(so_far[own] % BUCKETS)
        yield np.concatenate(owners), np.concatenate(buckets), text[new:]
        before, text_before = about[:, -(LONGEST - 1) :], text[-(LONGEST - 1) :]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts of a few rows at a time, so that what is joined stays near JOINED_BYTES, or is one text."""
    column = batch.column("text").cast(pa.large_binary())
    at, texts, held = 0, [], 0
    for i, text in enumerate(column):
        own = text.as_py() or b""
        if texts and held + len(own) > JOINED_BYTES:
            yield at, texts
            at, texts, held = i, [], 0
        texts.append(own)
        held += len(own)
    if texts:
        yield at, texts


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts = Words(), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, texts in _groups(batch):
            for _, buckets, _ in features_of(texts, words):
                counts += np.bincount(buckets, minlength=BUCKETS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])


def _weighing(gains: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for at, texts in _groups(batch):
                own = slice(at, at + len(texts))
                for owners, buckets, of_words in features_of(texts, words):
                    n_words[own] += np.bincount(of_words, minlength=len(texts))
                    n_features[own] += np.bincount(owners, minlength=len(texts))
                    weight[own] += np.bincount(owners, weights=gains[buckets], minlength=len(texts)).astype(np.int64)  # whole numbers below 2^53
            own = [batch.column(c) for c in ("_file", "_row", "doc_id")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n_words), pa.array(n_features), pa.array(weight)], ["_file", "_row", "doc_id", "n_words", "n_features", "weight"])

    return run


def bucket_counts(table: DataFrame) -> np.ndarray:
    """How many features of all texts are in each bucket; a task gives a row for each bucket, and the driver gets their sums, BUCKETS at most."""
    rows = table.select("text").mapInArrow(_counting, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        counts[r.bucket] = r.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier a bucket is in the target, one added to each count."""
    all_s, all_t = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, seed: str = "42", min_words: int = MIN_WORDS) -> DataFrame:
    """_file, _row, doc_id, n_words, n_features, weight, score, rank for every row of docs: rank for the percent of them that the target's features draw, else null.

    Features are runs of one to LONGEST words, in BUCKETS buckets by crc32, counted over all whole texts of docs and of target.
    A document's weight is the sum of its features' gains; the score adds noise that the seed and doc_id draw, so that the
    best scores are a draw without replacement by importance. Of the documents with at least min_words words the best floor(percent %)
    are ranked, ties by doc_id, null last, then by their place; ranks come from ranges of the order, so no task sorts them all.

    Null and empty texts have no features and weigh 0; texts of any length are read a part at a time; a null doc_id draws noise as an
    empty one; rows that repeat count one by one. With an empty target all t are 0; an empty table gives no rows. Columns
    besides doc_id and text are not read. What the driver and tasks hold of the corpora is BUCKETS numbers each.
    """
    spark = docs.sparkSession
    placed_rows = common.with_locator(docs, "doc_id", "text")
    rows = placed_rows.select("_file", "_row", placed_rows["doc_id"].cast("long").alias("doc_id"), "text")
    with common.small_batches(spark):
        gains = bucket_gains(bucket_counts(rows), bucket_counts(target.select(target["text"].alias("text"))))
        weighed = common.staged(rows.mapInArrow(_weighing(gains), "_file string, _row long, doc_id long, n_words long, n_features long, weight long"), "weights")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    long_enough = F.col("n_words") >= min_words
    drawn = weighed.filter(long_enough).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_file"), F.col("_row")]
    ranked = placed(scored.filter(long_enough), [], order, "_place")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long")
    columns = ["_file", "_row", "doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(scored.filter(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of docs that resample draws, all columns; rows that repeat are drawn one by one, an empty table stays empty."""
    docs = common.filed(docs)
    rows = common.with_locator(docs)
    with common.scratch(docs.sparkSession):
        drawn = resample(docs, target, **settings).filter("rank IS NOT NULL").select(F.col("_file").alias("_f"), F.col("_row").alias("_r"))
        drawn = common.staged(drawn, "drawn", keep=True)
    drawn = common.bounded_broadcast(drawn)
    return rows.join(drawn, (rows["_file"] == drawn["_f"]) & (rows["_row"] == drawn["_r"]), "left_semi").select("_doc.*")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    with common.scratch(spark):
        found = common.staged(resample(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "resampled", keep=True)
    return found.select("doc_id", "n_features", "weight", "score", "rank")
