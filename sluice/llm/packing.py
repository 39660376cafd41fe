"""Packing along a space-filling curve: hashed document vectors, a Hilbert key, a range sort, and sequences cut from neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common, tokens

#: Dimensions of a hashed vector, of its projection, and bits of each projected coordinate.
HASHED, DIMS, BITS = 256, 3, 16
#: Bytes of text in a part, and parts at most unless `most_parts` says otherwise: a larger input has larger parts, which are sorted on disk and packed as a stream.
PART_BYTES, MOST_PARTS = 24 << 20, 16_384
#: Texts in an Arrow batch, and pieces whose ids an encoder remembers.
BATCH_ROWS, MEMO = 500, 100_000
#: Sampled places a part, where its borders are looked for.
SAMPLES = 64
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def projection() -> np.ndarray:
    """HASHED x DIMS of random signs, the same everywhere."""
    return np.random.default_rng(20_240_501).choice([-1.0, 1.0], size=(HASHED, DIMS))


def pair_table() -> np.ndarray:
    """A bucket for each pair of bytes, by a multiplicative hash."""
    return ((np.arange(1 << 16, dtype=np.uint32) * np.uint32(2_654_435_761)) >> np.uint32(24)).astype(np.intp)


def coordinates(text: bytes, signs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where a text lies in the unit cube: its byte pairs hashed to counts, centred, scaled to length 1, projected, squashed."""
    if len(text) < 2:
        return np.full(DIMS, 0.5)
    even, odd = (np.frombuffer(text, dtype="<u2", offset=k, count=(len(text) - k) // 2) for k in (0, 1))
    counts = (np.bincount(table[even], minlength=HASHED) + np.bincount(table[odd], minlength=HASHED)).astype(float)
    counts -= counts.mean()
    at = counts @ signs / max(np.sqrt(counts @ counts), 1e-9)
    return 1 / (1 + np.exp(-1.7 * at))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points in the unit cube (rows), as integers of `bits` bits a dimension.

    From the highest bit down, every dimension's bit either reflects the first one's lower bits or swaps them with its own;
    the Gray code of what is left, its bits interleaved, is the place.
    """
    x = np.minimum((points * (1 << bits)).astype(np.int64), (1 << bits) - 1).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            on = (x[i] >> bit & 1).astype(bool)
            moved = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, 0) ^ moved
            x[i] ^= moved
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(flip)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def places(texts: pa.Array, ties: np.ndarray) -> np.ndarray:
    """Hilbert key and below it the leading bits of the hash, so that equal keys are parted: 63 bits that sort as the curve does."""
    signs, table = projection(), pair_table()
    points = np.stack([coordinates((t.as_py() or "").encode(), signs, table) for t in texts])
    below = 63 - DIMS * BITS
    return hilbert_keys(points) << below | (ties.astype(np.int64).view(np.uint64) >> np.uint64(64 - below)).astype(np.int64)


def _keyed(borders: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = places(batch.column("text"), batch.column("tie").to_numpy())
                part = np.searchsorted(np.array(borders, dtype=np.int64), at, side="right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(part)], ["doc_id", "tie", "text", "place", "part"])

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            at = places(batch.column("text"), batch.column("tie").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("hits")], ["place", "hits"])


def part_borders(rows: DataFrame, part_bytes: int = PART_BYTES, most_parts: int = MOST_PARTS) -> list[int]:
    """Places on the curve that cut rows (doc_id, tie, text) into parts of about equal bytes of text, part_bytes or what most_parts of them make, one fewer than there are parts.

    A text is hit once in every part_bytes / SAMPLES bytes on average, decided by its hash, and only texts that are hit have
    their place worked out; quantiles of the hits' places are the borders. So a part of long texts has few of them. The
    borders decide where documents lie, not which ones are packed.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    total = rows.agg(F.sum(size.cast("long"))).first()[0] or 0
    parts = min(most_parts, -(-total // part_bytes))
    if parts <= 1:
        return []
    hits = F.floor(size * F.lit(SAMPLES * parts / total) + F.pmod(F.col("tie"), F.lit(1_000_003)) / F.lit(1_000_003.0)).cast("int")
    sample = rows.withColumn("hits", hits).filter("hits > 0").select("text", "tie", "hits").mapInArrow(_places, "place long, hits int")
    sample = sample.withColumn("_hit", F.explode(F.sequence(F.lit(1), "hits")))
    cuts = sample.agg(F.percentile_approx("place", [k / parts for k in range(1, parts)], 20 * parts)).first()[0]
    return sorted(set(cuts or []))


def _packing(file: str, end_id: int, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first, filled = tokens.encoder(file, False, memo=MEMO), TaskContext.get().partitionId() << 40, 0  # filled: ids so far in this part
        for batch in batches:
            ids, bounds = encode(batch.column("text"), end_id)
            if not len(ids):
                continue
            # a piece starts where a document or a sequence does
            edges = np.arange(-filled % length, len(ids), length)
            starts = np.union1d(bounds[:-1], edges)
            sizes = np.diff(np.append(starts, len(ids)))
            of = np.searchsorted(bounds, starts, side="right") - 1
            at = filled + starts
            binary = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((np.append(starts, len(ids)) * 4).astype(np.int32)), pa.py_buffer(ids)])
            columns = [batch.column("doc_id").take(pa.array(of)), pa.array(starts - bounds[of]), pa.array(sizes), binary, pa.array(np.diff(bounds)[of]), pa.array(first + at // length), pa.array(at % length)]
            yield pa.RecordBatch.from_arrays(columns, names)
            filled += len(ids)
        pa.default_memory_pool().release_unused()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 1024, part_bytes: int = PART_BYTES, most_parts: int = MOST_PARTS) -> DataFrame:
    """Pieces of documents in sequences of `length` ids: doc_id, start, length, ids (unsigned 32-bit, little endian), doc_tokens, sequence_id, offset.

    Documents are range-parted by the Hilbert key of their projected vectors into parts of about part_bytes of text
    (part_borders), sorted there, and each part is cut into sequences from end to end, so neighbours on the curve share
    sequences; only a part's last sequence isn't full. Encoding comes after the sort, once, and streams.
    Equal keys are parted by a hash of doc_id and text, so a group of copies of any size spreads over parts. A null text has
    only the end id, as has an empty one; a text of any length is cut freely; rows that repeat are packed as often as they
    come; an empty table gives no rows; columns besides doc_id and text are not read. Run it inside common.small_batches,
    since Arrow batches hold whole texts.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["doc_id"], docs["text"]).alias("tie"), docs["text"].alias("text"))
    with common.small_batches(docs.sparkSession):
        borders = part_borders(rows, part_bytes, most_parts)
    keyed = rows.mapInArrow(_keyed(borders), "doc_id long, tie long, text string, place long, part int")
    ranged = keyed.repartitionById(len(borders) + 1, "part").sortWithinPartitions("place", "tie", "doc_id").select("doc_id", "text")
    return ranged.mapInArrow(_packing(tokenizer, end_id, length), PIECES)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """`pack` with byte_bpe_50k.json and end id 0, the ids of each piece as their checksum."""
    import public_tokenizers

    with common.small_batches(docs.sparkSession, BATCH_ROWS):
        pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 0)
        return common.staged(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"), "pieces")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(common.documents(spark, sf_dir))
