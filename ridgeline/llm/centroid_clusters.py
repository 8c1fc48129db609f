"""Centroid clustering over dictionaries of subvectors.

A task cuts its vectors into chunks and each chunk's dimensions into blocks.  A block
is dictionary-encoded without loss: its distinct subvectors, and a code for each
vector.  Chunks are written once, as Parquet.  In every round a chunk computes the
squared distance of each distinct subvector to each centroid's block once; a vector's
distance is the sum of its codes' partial distances.  Sums for the new centroids come
from the codes as well: how often a cluster has a code, times the subvector.

Only the centroids and their sums pass through the driver; all numbers are exact integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import int_vectors as V
from . import kernel as K
from .shared import materialise

CHUNK = 16_384
BLOCK = 2
_CHUNKS = "ids array<long>, sizes array<int>, entries binary, codes binary"
_CHUNKS_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                           ("entries", pa.binary()), ("codes", pa.binary())])


@dataclass
class Chunk:
    ids: pa.Array
    entries: list[np.ndarray]       # of each block: its distinct subvectors
    codes: list[np.ndarray]         # of each block: the vectors' places among them

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of each vector to each centroid."""
        out, at = 0, 0
        for entries, codes in zip(self.entries, self.codes, strict=True):
            block = centroids[:, at:at + entries.shape[1]]
            e, c = V.same_kind(entries, block)
            out = out + ((e[:, None, :] - c[None]) ** 2).sum(axis=2)[codes]
            at += entries.shape[1]
        return out

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Count and component sums of each cluster, as Python integers."""
        parts = [np.bincount(cluster, minlength=k).astype(object)[:, None]]
        for entries, codes in zip(self.entries, self.codes, strict=True):
            often = np.bincount(cluster * len(entries) + codes, minlength=k * len(entries)).reshape(k, -1)
            parts.append((often.astype(entries.dtype) @ entries).astype(object))
        return np.concatenate(parts, axis=1)


def distinct(sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, the place of each row among them)"""
    order = np.lexsort(sub.T[::-1])
    ranked = sub[order]
    new = np.ones(len(sub), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    code = np.empty(len(sub), np.int64)
    code[order] = np.cumsum(new) - 1
    return ranked[new], code


def _encode(dims: int, scale: int):
    @K.released
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                rows, x = V.read(part.column("vec"), scale, dims)
                if not len(rows):
                    continue
                blocks = [distinct(x[:, at:at + BLOCK]) for at in range(0, dims, BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), part.column("id").take(pa.array(rows))),
                     pa.array([[len(e) for e, _ in blocks]], pa.list_(pa.int32())),
                     pa.array([b"".join(e.tobytes() for e, _ in blocks)], pa.binary()),
                     pa.array([b"".join(c.astype(np.uint16).tobytes() for _, c in blocks)], pa.binary())],
                    schema=_CHUNKS_ARROW)
    return run


def _chunks(batch: pa.RecordBatch, dims: int):
    for i in range(batch.num_rows):
        ids = batch.column("ids").slice(i, 1).flatten()
        sizes = batch.column("sizes")[i].as_py()
        values = np.frombuffer(batch.column("entries")[i].as_buffer(), np.float64)
        codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint16).reshape(len(sizes), -1).astype(np.int64)
        entries, at = [], 0
        for b, size in enumerate(sizes):
            width = min(BLOCK, dims - b * BLOCK)
            entries.append(V.whole(values[at:at + size * width].reshape(size, width)))
            at += size * width
        yield Chunk(ids, entries, list(codes))


def _sum_chunks(shared):
    @K.released
    def run(batches):
        centroids = shared.value
        total = np.zeros((len(centroids), centroids.shape[1] + 1), object)
        for batch in batches:
            for chunk in _chunks(batch, centroids.shape[1]):
                total += chunk.sums(chunk.distances(centroids).argmin(axis=1), len(centroids))
        yield from V.emit_sums(total)
    return run


def _assign(shared):
    @K.released
    def run(batches):
        centroids = shared.value
        for batch in batches:
            for chunk in _chunks(batch, centroids.shape[1]):
                d = chunk.distances(centroids)
                nearest = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [chunk.ids, pa.array(nearest, pa.int32()), V.as_long(d[np.arange(len(d)), nearest])],
                    names=["vec_id", "cluster", "distance"])
    return run


def _seeds(dims: int, scale: int):
    schema = pa.schema([("id", pa.int64()), ("vec", pa.list_(pa.float64()))])

    @K.released
    def run(batches):
        for batch in batches:
            rows, x = V.read(batch.column("vec"), scale, dims)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dims, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), flat], schema=schema)
    return run


def cluster_vectors(vectors: DataFrame, dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, salt: str = "1:",
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept row of ``vectors``.

    Kept are vectors of exactly ``dims`` components, none of them null or non-finite
    (2^150 / ``scale`` and more counts as non-finite).  The first centroids are the kept vectors with the
    smallest sha256 of ``salt`` and id (rows with a null id come last; of equal ids the
    smaller vector first), as many as there are if fewer than ``k``.  Ties go to the
    smaller centroid, a centroid without vectors stays.  Rows may repeat, each is a
    vector of its own; other columns are ignored; no kept row gives an empty result.
    A distance or sum above the largest long is reported as that.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vec"))
    hashed = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    seeds = (rows.mapInArrow(_seeds(dims, scale), "id long, vec array<double>")
             .orderBy(hashed.asc_nulls_last(), "vec").limit(k).collect())
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    centroids = V.whole(np.array([r.vec for r in seeds]))
    chunks = materialise(rows.mapInArrow(_encode(dims, scale), _CHUNKS), "centroid-chunks")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)
        total = V.total_sums(chunks.mapInArrow(_sum_chunks(shared), V.SUMS), len(centroids), dims + 1)
        centroids = V.whole(np.array([[s // row[0] for s in row[1:]] if row[0] else list(old)
                                      for row, old in zip(total, centroids, strict=True)], object))
    shared = spark.sparkContext.broadcast(centroids)
    assigned = materialise(chunks.mapInArrow(_assign(shared), "vec_id long, cluster int, distance long"), "centroid-assigned")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(V.long_sum("distance").alias("s")).collect()}
    everything = min(sum(inertia.values()), V.LONG_MAX)
    facts = [(i, inertia.get(i, 0), hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest())
             for i, c in enumerate(centroids)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")     # k rows
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(everything).cast("long").alias("inertia"), "centroid_sha256")
