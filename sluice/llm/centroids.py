"""Centroid clustering in whole numbers: vectors and centroids as bit planes, exact distances by weighted AND-popcounts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common

#: Components of a vector; a plane of them is one 64-bit word.
WIDTH = 64
#: With more planes than this a squared distance may not fit a long.
MOST_PLANES = 28


def plane_weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts, in two's complement: 1, 2, 4 and so on, the last one less than 0."""
    weights = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """(n, planes) words of 64 bits from (n, 64) whole numbers: bit i of word p is bit p of component i."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(words: np.ndarray) -> np.ndarray:
    """The whole numbers that were packed."""
    octets = np.ascontiguousarray(words.astype("<u8"))[:, :, None].view(np.uint8)
    bits = np.unpackbits(octets, axis=2, bitorder="little")
    return np.einsum("npi,p->ni", bits, plane_weights(words.shape[1]), dtype=np.int64, casting="unsafe")


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of all packed a with all packed b: each pair of planes adds its weights' product for every bit that both have."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    wa, wb = plane_weights(a.shape[1]), plane_weights(b.shape[1])
    for p in range(a.shape[1]):
        for q in range(b.shape[1]):
            out += (wa[p] * wb[q]) * np.bitwise_count(a[:, p, None] & b[None, :, q]).astype(np.int64)
    return out


def squares(words: np.ndarray) -> np.ndarray:
    """Each packed vector's dot product with itself."""
    weights = plane_weights(words.shape[1])
    out = np.zeros(len(words), dtype=np.int64)
    for p in range(words.shape[1]):
        for q in range(words.shape[1]):
            out += (weights[p] * weights[q]) * np.bitwise_count(words[:, p] & words[:, q]).astype(np.int64)
    return out


def nearest(words: np.ndarray, square: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre's number, the smaller one of equals, and the squared distance to it."""
    distance = square[:, None] - 2 * dots(words, centres) + squares(centres)[None, :]
    at = distance.argmin(axis=1)
    return at, distance[np.arange(len(at)), at]


def _words(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    return batch.column("planes").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, planes)


def kept_vectors(table: DataFrame, vector: str) -> DataFrame:
    """vec_id and vector, as doubles, of the rows with exactly 64 components, none null, infinite or not a number."""
    x = F.col("vector")
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), table[vector].cast("array<double>").alias("vector"))
    return rows.filter((F.size(x) == WIDTH) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))


def _packing(scale: float, planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.floor(scale * batch.column("vector").flatten().to_numpy().reshape(-1, WIDTH)).astype(np.int64)
            words = pack(values, planes)
            lists = pa.ListArray.from_arrays(np.arange(0, words.size + 1, planes, dtype=np.int32), pa.array(words.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists, pa.array(squares(words))], ["vec_id", "planes", "square"])

    return run


def _summing(centres: np.ndarray):
    """A row for each centre that vectors of a task are nearest to: how many there are, and their sums by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centres), dtype=np.int64), np.zeros((len(centres), WIDTH), dtype=np.int64)
        for batch in batches:
            words = _words(batch, centres.shape[1])
            at, _ = nearest(words, batch.column("square").to_numpy(), centres)
            order = np.argsort(at, kind="stable")
            found, first = np.unique(at[order], return_index=True)
            if len(found):
                n[found] += np.diff(np.append(first, len(at)))
                sums[found] += np.add.reduceat(unpack(words)[order], first, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), *[pa.array(sums[some, i]) for i in range(WIDTH)]], ["cluster", "n", *[f"s{i}" for i in range(WIDTH)]])

    return run


def _assigning(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, distance = nearest(_words(batch, centres.shape[1]), batch.column("square").to_numpy(), centres)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def centroid_clusters(table: DataFrame, *, vector: str = "embedding", k: int = 40, rounds: int = 5, scale: float = 256.0, seed: str = "2") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every kept vector; the final centroids, as many rows of 64 whole numbers).

    A component x becomes floor(scale * x), and a vector one 64-bit word for each bit that the largest component needs; these
    planes are written once and read in every round. Centroids start as the k vectors whose sha256 of seed:vec_id is smallest.
    A round assigns every vector to the nearest centroid, the smaller number among equals, and moves each centroid that has
    vectors to the exact floor of their mean; at the end vectors are assigned once more. Tasks get k centroids and give back k
    rows of sums, which are added up by centroid; so the driver sees k * 64 numbers a round, whatever the input, and a common
    vector or a large cluster is summed where it lies.

    Vectors of another length, or with a component that is null, infinite or not a number, are left out; rows that repeat count
    one by one; a null vec_id is hashed as an empty one; vectors with one hash start in the order of their planes. Fewer than k
    vectors give fewer centroids, an empty table gives no rows. Components beyond 2^27 / scale are an error, since distances
    wouldn't fit a long. Columns besides vec_id and the vector are not read.
    """
    spark = table.sparkSession
    rows = kept_vectors(table, vector)
    least, most = rows.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    if least is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, WIDTH), dtype=np.int64)
    bits = max((~x if x < 0 else x).bit_length() for x in (int(np.floor(scale * least)), int(np.floor(scale * most))))
    planes = bits + 1
    if planes > MOST_PLANES:
        raise ValueError(f"components of {bits} bits: squared distances may not fit a long")
    packed = common.staged(rows.mapInArrow(_packing(scale, planes), "vec_id long, planes array<long>, square long"), "vector-planes")

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = packed.select("planes", digest.alias("digest")).orderBy("digest", "planes").limit(k).collect()
    centres = unpack(np.array([r.planes for r in start], dtype=np.int64).view(np.uint64))
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(WIDTH)]
    schema = "cluster long, n long, " + ", ".join(f"s{i} long" for i in range(WIDTH))
    for _ in range(rounds):
        moved = packed.mapInArrow(_summing(pack(centres, planes)), schema).groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect()
        for r in moved:
            centres[r.cluster] = [r[f"s{i}"] // r.n for i in range(WIDTH)]
    return packed.mapInArrow(_assigning(pack(centres, planes)), "vec_id long, cluster int, distance long"), centres


def centroid_digests(centres: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    with common.scratch(spark):
        found, centres = centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
        rows = common.staged(found, "clusters", keep=True)
    inertia = {r.cluster: r.d for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row for each centroid
    about = [(i, inertia.get(i, 0), sum(inertia.values()), digest) for i, digest in enumerate(centroid_digests(centres))]
    clusters = spark.createDataFrame(about, "_c int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = rows.join(F.broadcast(clusters), rows["cluster"] == clusters["_c"])
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after another, each vector held against every centroid."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings WHERE len(embedding) = {WIDTH} AND list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding]))",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT r, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_transform(list_zip(v.x, c.x), lambda p: [p[1], p[2]])])::BIGINT AS d FROM v, c{i} c) GROUP BY r)")
        if i < rounds:
            floor = "CAST(s // n - CASE WHEN s % n <> 0 AND s < 0 THEN 1 ELSE 0 END AS BIGINT)"
            parts.append(f"m{i} AS MATERIALIZED (SELECT c, list({floor} ORDER BY j) AS x FROM (SELECT c, j, sum(e) AS s, count(*) AS n FROM (SELECT a.c, unnest(v.x) AS e, unnest(range({WIDTH})) AS j FROM v JOIN a{i} a ON v.r = a.r) GROUP BY c, j) GROUP BY c)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.c = m.c)")
    return f"WITH {', '.join(parts)} SELECT vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM v JOIN a{rounds} a ON v.r = a.r JOIN c{rounds} c ON a.c = c.c"


OP11_SQL = _sql()
