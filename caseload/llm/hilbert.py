"""Centroid clustering over space-filling-curve zone maps.

Vectors become whole numbers, are put in the order of a Hilbert curve through
their box, and are cut into blocks of neighbours, each stored with the least
and largest value of every component (its zone map).  In a round of k-means
the distance of a centroid to a block's box bounds its distance to every
vector of the block from below and above; only the centroids that could be the
nearest of some vector are compared, all at once, with the block's vectors.
Distances are whole numbers, so assignments and sums are exact.

Plan: one shuffle of the vectors, for the order; afterwards a round reads the
written blocks and hands on one row of sums per task and centroid, and only
the centroids (``k`` rows) come to the driver.  Blocks have a fixed size; a
vector that a third of the rows hold fills blocks of its own.

Edge cases: a null or shorter or longer vector, or one with a null, NaN or
infinite component, is left out; components are held within +-2**27 after
scaling, so that a squared distance fits 64 bits; an inertia that does not fit
is null; with fewer than ``k`` vectors each starts a cluster; a null
``vec_id`` is hashed as ``null``; rows that repeat an id are vectors of their
own; equally distant centroids: the smaller number wins; other columns,
whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.llm.common import written

SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
#: Vectors in a block, and bits of each component along the curve.
BLOCK = 256
BITS = 4
#: Vectors in a task of the ordering shuffle: from LEAST up to MOST as the input grows, about WANTED tasks in between.
LEAST, MOST, WANTED = 1 << 13, 1 << 20, 4096
_LIMIT = 1 << 27
#: Up to here all sums of squares are whole numbers that doubles hold exactly.
_EXACT = 1 << 52


def whole_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<int>) of the vectors that count, each component floor(scale * x)."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))

    def whole(x: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(float(_LIMIT))),
                                    F.lit(float(-_LIMIT))))
        return scaled.cast("int")

    kept = vectors.where((F.size("embedding") == size) & ~F.exists("embedding", bad))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each point (a row of numbers below
    ``2 ** bits``), as big-endian bytes, by Skilling's transform: undo the
    turns of the curve level by level, then Gray-code."""
    x = np.ascontiguousarray(points.T).astype(np.uint32)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for k in range(len(x)):
            high = (x[k] >> np.uint32(level)) & np.uint32(1)
            turn = np.where(high == 1, np.uint32(0), (x[0] ^ x[k]) & low)
            x[0] ^= np.where(high == 1, low, turn)
            x[k] ^= turn
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint32(level) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)


def _matrix(batch: pa.RecordBatch, column: int, size: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _extent(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(size, _LIMIT), np.full(size, -_LIMIT)
        for batch in batches:
            v = _matrix(batch, 0, size)
            if len(v):
                low, high = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(low, pa.int64()),
                                          pa.array(high, pa.int64())], ["k", "low", "high"])

    found = rows.select("v").mapInArrow(run, "k int, low long, high long").groupBy("k").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("k").collect()  # ``size`` rows
    return np.array([r["low"] for r in found], np.int64), np.array([r["high"] for r in found], np.int64)


def blocks(rows: DataFrame, size: int = SIZE, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """(ids, v, low, high): the vectors of ``rows`` (written) in curve order, ``block`` to a row, with their box."""
    n = rows.count()
    low, high = _extent(rows, size) if n else (np.zeros(size, np.int64), np.ones(size, np.int64))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch, 1, size).astype(np.int64)
            cells = ((v - low) << bits) // (high - low + 1)
            keys = hilbert_keys(cells, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(bytes, keys)), pa.binary()), batch.column(0),
                 pa.array(list(map(bytes, v.astype("<i4"))), pa.binary())], ["key", "vec_id", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4").reshape(-1, size)
            out: list[list] = [[], [], [], []]
            for at in range(0, len(v), block):
                part = v[at:at + block]
                out[0].append(batch.column(1).slice(at, block).to_pylist())
                for k, x in enumerate((part, part.min(axis=0), part.max(axis=0)), 1):
                    out[k].append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.int64())),
                                              *[pa.array(x, pa.binary()) for x in out[1:]]], ["ids", "v", "low", "high"])

    order = ["key", "vec_id", "at"]
    ordered = (rows.mapInArrow(keyed, "key binary, vec_id long, v binary").withColumn("at", F.monotonically_increasing_id())
               .repartitionByRange(max(1, math.ceil(n / min(MOST, max(LEAST, n // WANTED)))), *order)
               .sortWithinPartitions(*order).select("key", "vec_id", "v"))
    return written(ordered.mapInArrow(cut, "ids array<long>, v binary, low binary, high binary"), "hilbert-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to a vector in the box: those no
    farther from it than the centroid whose farthest corner is nearest."""
    low, high, c = low.astype(np.int64), high.astype(np.int64), centroids
    near = np.maximum(np.maximum(low - c, c - high), 0)
    far = np.maximum(np.abs(c - low), np.abs(c - high))
    return np.flatnonzero((near * near).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest centroid of each vector; the
    first of equally near ones.  Exact: by products of doubles while all their
    sums are whole numbers that doubles hold, else in 64-bit numbers."""
    largest = 2 * int(max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)))
    if v.shape[1] * largest * largest <= _EXACT:
        a, c = v.astype(np.float64), centroids.astype(np.float64)
        d = (c * c).sum(axis=1) - 2 * (a @ c.T)
        best = d.argmin(axis=1)
        return best, (d[np.arange(len(d)), best] + (a * a).sum(axis=1)).astype(np.int64)
    v = v.astype(np.int64)
    d = np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(ids, vectors, cluster, distance, candidates) of each block."""
    size = centroids.shape[1]
    for ids, *parts in zip(*(c.to_pylist() for c in batch.columns)):
        v, low, high = (np.frombuffer(x, "<i4").reshape(-1, size) for x in parts)
        near = candidates(low, high, centroids)
        best, distance = nearest(v, centroids[near])
        yield ids, v, near[best], distance, len(near)


def refined(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, every centroid that
    has vectors to their componentwise floor(sum / count)."""
    shared, (k, size) = stored.sparkSession.sparkContext.broadcast(centroids), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for _, v, cluster, _, _ in _assigned(batch, shared.value):
                count += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    total[c] += v[cluster == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(list(np.c_[count, total][some]), pa.list_(pa.int64()))],
            ["cluster", "sums"])

    sums = stored.mapInArrow(run, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("k", "x"))
    found: dict[int, dict] = {}
    for row in sums.groupBy("cluster", "k").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():  # k * (size + 1)
        found.setdefault(row["cluster"], {})[row["k"]] = int(row["x"])
    out = centroids.copy()
    for cluster, total in found.items():
        out[cluster] = [total[i + 1] // total[0] for i in range(size)]
    return out


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of their ids, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    found = rows.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # ``k`` rows
    return np.array([r["v"] for r in found], np.int64)


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
              seed: str = SEED, block: int = BLOCK) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    n_candidates) of every vector that counts; ``n_candidates`` is how many
    centroids its block was compared with in the last assignment."""
    rows = written(whole_vectors(vectors, size, scale), "hilbert-vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, size)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"), F.lit(0).alias("n_candidates"))
    stored = blocks(rows, size, block)
    for _ in range(rounds):
        centroids = refined(stored, centroids)
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, distance, n in _assigned(batch, shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance),
                     pa.array(np.full(len(ids), n, np.int32))], ["vec_id", "cluster", "distance", "n_candidates"])

    found = written(stored.mapInArrow(run, "vec_id long, cluster int, distance long, n_candidates int"), "hilbert-clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = written(found.groupBy("cluster").agg(exact.alias("total")), "hilbert-inertia")  # at most ``k`` rows
    every = F.sum("total").over(Window.partitionBy())
    digest = F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1)
    per = per.select("cluster", F.col("total").try_cast("bigint").alias("cluster_inertia"),
                     every.try_cast("bigint").alias("inertia"), digest.alias("centroid_sha256"))
    return found.join(per, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                             "centroid_sha256", "n_candidates")
