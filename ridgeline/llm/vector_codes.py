"""Vector code compression: product quantisation with anchors-hierarchy trees over the parts.

Vectors are cut into equal parts; each part position has a codebook, and a vector's code
is the number of the nearest entry at each position.  A task cuts its vectors into
chunks and builds one metric tree (see :mod:`anchors`) over the distinct subvectors of
each position; trees are written once, as Parquet.  In each round a chunk walks its trees
with the entries as candidates: balls that one entry owns whole add their cached
sums and counts, and the rest is decided in the leaves.  The driver holds
codebooks and their sums, which do not grow with the input; all numbers are exact integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors as A
from . import int_vectors as V
from . import kernel as K
from .centroid_clusters import distinct
from .shared import materialise

CHUNK = 8192


@dataclass
class Part:
    """The subvectors of one position in a chunk."""
    tree: A.Tree | None     # None: too large for int64, compared one by one
    points: np.ndarray
    weight: np.ndarray
    place: np.ndarray       # of each vector among the points

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each point, points of each entry, their component sums)"""
        if self.tree is not None and entries.dtype != object:
            return A.nearest(self.tree, entries)[:3]
        points, entries = (a.astype(object) for a in (self.points, entries))
        code = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        count, total = np.zeros(len(entries), object), np.zeros(entries.shape, object)
        np.add.at(count, code, self.weight.astype(object))
        np.add.at(total, code, points * self.weight.astype(object)[:, None])
        return code, count, total


def _encode(dims: int, parts: int, scale: int):
    width = dims // parts

    @K.released
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(lo, CHUNK)
                rows, x = V.read(piece.column("vec"), scale, dims)
                if not len(rows):
                    continue
                trees, places = [], []
                for at in range(0, dims, width):
                    points, code = distinct(x[:, at:at + width])
                    weight = np.bincount(code)
                    points = V.whole(points)
                    if points.dtype == object:
                        trees.append(b"")
                        places.append(x[:, at:at + width].tobytes())
                        continue
                    tree, place = A.build(points, weight)
                    trees.append(tree.dumps())
                    places.append(place[code].astype(np.uint16).tobytes())
                of = pa.array([0, len(rows)], pa.int32())
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(of, piece.column(c).take(taken)) for c in ("id", "label")]
                    + [pa.array([trees], pa.list_(pa.binary())), pa.array([places], pa.list_(pa.binary()))],
                    names=["ids", "labels", "trees", "places"])
    return run


def _parts(trees: list[bytes], places: list[bytes], width: int):
    for tree, place in zip(trees, places, strict=True):
        if not tree:
            points, code = distinct(np.frombuffer(place, np.float64).reshape(-1, width))
            yield Part(None, V.whole(points), np.bincount(code), code)
        else:
            t = A.Tree.loads(tree)
            yield Part(t, t.points, t.weight, np.frombuffer(place, np.uint16).astype(np.int64))


def _sum_chunks(shared):
    @K.released
    def run(batches):
        books = shared.value
        parts, (k, width) = len(books), books[0].shape
        total = np.zeros((parts * k, width + 1), object)
        for batch in batches:
            for i in range(batch.num_rows):
                trees, places = batch.column("trees")[i].as_py(), batch.column("places")[i].as_py()
                for p, part in enumerate(_parts(trees, places, width)):
                    _, count, sums = part.nearest(books[p])
                    total[p * k:(p + 1) * k, 0] += count
                    total[p * k:(p + 1) * k, 1:] += sums
        yield from V.emit_sums(total)
    return run


def _assign(shared):
    @K.released
    def run(batches):
        books = shared.value
        width = books[0].shape[1]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
                codes, error = np.empty((len(ids), len(books)), np.uint8), 0
                trees, places = batch.column("trees")[i].as_py(), batch.column("places")[i].as_py()
                for p, part in enumerate(_parts(trees, places, width)):
                    code = part.nearest(books[p])[0]
                    points, entries = V.same_kind(part.points, books[p])
                    error = error + ((points - entries[code]) ** 2).sum(axis=1)[part.place]
                    codes[:, p] = code[part.place]
                texts = codes.tobytes().hex()
                size = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([texts[j:j + size] for j in range(0, len(texts), size)], pa.string()), V.as_long(error)],
                    names=["vec_id", "label", "code", "error"])
    return run


def _first(dims: int, scale: int):
    schema = pa.schema([("id", pa.int64()), ("vec", pa.list_(pa.float64()))])

    @K.released
    def run(batches):
        for batch in batches:
            rows, x = V.read(batch.column("vec"), scale, dims)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dims, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), flat], schema=schema)
    return run


def compress(vectors: DataFrame, dims: int = 64, parts: int = 16, scale: int = 256, entries: int = 64, rounds: int = 2,
             id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> tuple[DataFrame, list]:
    """(vec_id, label, code, error for each kept row of ``vectors``; the final codebook of each part).

    Kept are vectors of ``dims`` components, none of them null or non-finite (2^150 / ``scale`` and
    more counts as non-finite); vectors of another length have no such parts and are left out.
    The codebooks start with the vectors of the ``entries`` smallest ids (at most 256; null ids come last,
    of equal ids the smaller vector first), fewer if there are not so many.  Ties go to the lower
    entry, an entry without parts stays.  Rows may repeat, each is a vector of its own;
    other columns are ignored; no kept row gives an empty result and no codebooks.  An error above the
    largest long is reported as that.
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError(f"{dims} components do not make {parts} equal parts, or {entries} entries are not 1 to 256")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vec"),
                          F.col(label_column).alias("label"))
    start = (rows.select("id", "vec").mapInArrow(_first(dims, scale), "id long, vec array<double>")
             .orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect())
    label = rows.schema["label"].dataType
    if not start:
        return spark.createDataFrame([], f"vec_id long, label {label.simpleString()}, code string, error long"), []
    x, width = np.array([r.vec for r in start]), dims // parts
    books = [V.whole(x[:, p * width:(p + 1) * width]) for p in range(parts)]
    chunks = materialise(rows.mapInArrow(
        _encode(dims, parts, scale),
        f"ids array<long>, labels array<{label.simpleString()}>, trees array<binary>, places array<binary>"), "codes-trees")
    k = len(start)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        total = V.total_sums(chunks.mapInArrow(_sum_chunks(shared), V.SUMS), parts * k, width + 1)
        books = [V.whole(np.array([[s // row[0] for s in row[1:]] if row[0] else list(old)
                                   for row, old in zip(total[p * k:(p + 1) * k], books[p], strict=True)], object))
                 for p in range(parts)]
    shared = spark.sparkContext.broadcast(books)
    out = chunks.mapInArrow(_assign(shared), f"vec_id long, label {label.simpleString()}, code string, error long")
    return materialise(out, "codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the errors of all rows with the same label (nulls together) added up.

    Errors are added up before the shuffle; the labels' table is written, so that the
    join broadcasts it when its size allows and else splits a frequent label.
    """
    totals = materialise(codes.groupBy("label").agg(V.long_sum("error").alias("label_error")), "codes-labels")
    totals = totals.select(F.col("label").alias("other"), "label_error")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("other")), "left").drop("other")


def digest(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each kept row."""
    codes, books = compress(vectors)
    numbers = ",".join(str(int(v)) for book in books for entry in book for v in entry)
    return with_label_errors(codes).select("vec_id", "code", "error", "label_error",
                                           F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))
