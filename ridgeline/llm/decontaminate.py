"""Benchmark decontamination: size-partitioned MinHash containment search.

A document contains a benchmark item when it holds at least 3/4 of the item's
distinct five-word shingles, wherever they stand in the text.  An item is a few
dozen shingles and a document may be tens of thousands, so equal-sized MinHash
signatures would say nothing; the sketches here follow the sizes instead:

- Items are partitioned by size (a class per doubling).  Under one permutation an
  item of ``q`` shingles keeps its ``q - ceil(3q/4) + 1`` smallest values: any set
  that holds 3/4 of the item holds one of these, so no leak is missed.
- A document's sketch for a class is its shingle values up to the largest value
  that the class's items kept; classes whose smallest item needs more shingles
  than the document has are skipped.
- A document and an item that share a sketch value are candidates; they are
  verified on their shingles themselves, compared as text.

Documents are only mapped, never shuffled.  The item index is broadcast, a slice
of bounded size at a time; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

SLICE_BYTES = 16 << 20
_SEED = np.uint64(0x8F3B1D2A6C5E4971)
_BITS = 20
_SCHEMA = "doc_id long, item_id long, shared long, item_shingles long"


def _need(q: int) -> int:
    return -(-3 * q // 4)


def shingle_texts(text: str) -> frozenset[bytes]:
    w = text.encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(b" ".join(w[i:i + K.SHINGLE]) for i in range(max(1, len(w) - K.SHINGLE + 1)))


class ItemIndex:
    """Sketches of one slice of benchmark items, by size class."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids, self.shingles, self.classes = [], [], []
        values, owners, tau = [], [], {}
        self.smallest: dict[int, int] = {}
        for item_id, text in items:
            wh, first = K.word_hashes(pa.array([text], pa.string()))
            low = K.distinct_sorted(K.mix(K.shingle_hashes(wh, first)[0] ^ _SEED))
            q = len(low)
            if not q:
                continue
            size_class = q.bit_length()
            kept = low[:q - _need(q) + 1]
            values.append(kept)
            owners.append(np.full(len(kept), len(self.ids)))
            tau[size_class] = max(tau.get(size_class, 0), int(kept[-1]))
            self.smallest[size_class] = min(self.smallest.get(size_class, q), q)
            self.ids.append(item_id)
            self.shingles.append(shingle_texts(text))
            self.classes.append(size_class)
        self.tau = np.uint64(max(tau.values(), default=0))
        v = np.concatenate(values) if values else np.zeros(0, np.uint64)
        o = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(v, kind="stable")
        self.values, self.owners = v[order], o[order]
        self.slots = np.zeros(1 << _BITS, dtype=bool)
        self.slots[(self.values >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def candidates(self, sh: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
        """{row: items} sharing a sketch value, rows large enough for the item's class only."""
        out: dict[int, set[int]] = defaultdict(set)
        h = K.mix(sh ^ _SEED)
        at = np.flatnonzero(h <= self.tau)
        at = at[self.slots[(h[at] >> np.uint64(64 - _BITS)).astype(np.int64)]]
        lo = np.searchsorted(self.values, h[at], "left")
        hi = np.searchsorted(self.values, h[at], "right")
        rows = np.searchsorted(off, at, "right") - 1
        for row, a, b in zip(rows[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
            size = int(off[row + 1] - off[row])
            for item in self.owners[a:b].tolist():
                if size >= _need(self.smallest[self.classes[item]]):
                    out[row].add(item)
        return out


def _search(index):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("shared", pa.int64()),
                        ("item_shingles", pa.int64())])

    @K.released
    def run(batches):
        items = index.value
        for batch in batches:
            for lo, hi in K.text_chunks(batch):
                texts = batch.column("text").slice(lo, hi - lo)
                wh, first = K.word_hashes(texts)
                found = []
                for row, hits in items.candidates(*K.shingle_hashes(wh, first)).items():
                    own = shingle_texts(texts[row].as_py())
                    for i in sorted(hits):
                        wanted = items.shingles[i]
                        shared = len(wanted & own)
                        if shared >= _need(len(wanted)):
                            found.append((batch.column("doc_id")[lo + row].as_py(), items.ids[i], shared, len(wanted)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)],
                                                     schema=schema)
    return run


def _indexes(benchmark: DataFrame, slice_bytes: int):
    """Broadcast indexes of the benchmark's items, about ``slice_bytes`` of text each."""
    spark = benchmark.sparkSession
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("text is not null").distinct())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).collect()
        yield spark.sparkContext.broadcast(ItemIndex([(r.item_id, r.text) for r in part]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every contained item.

    ``docs`` (doc_id, text, ...), ``benchmark`` (item_id, text, ...); other columns are
    ignored.  Null or blank texts hold nothing and are held by nothing.  An item of
    fewer than five words is one shingle and is found only in a text that is just
    those words.  Repeated items count once; a repeated document row repeats its
    result; null ids are passed through.  An empty table on either side gives an
    empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _indexes(benchmark, slice_bytes):
        found = texts.mapInArrow(_search(index), _SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out.withColumn("containment", F.col("shared") / F.col("item_shingles"))


def _filter(index):
    @K.released
    def run(batches):
        items = index.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, hi in K.text_chunks(batch):
                texts = batch.column("text").slice(lo, hi - lo)
                wh, first = K.word_hashes(texts)
                for row, hits in items.candidates(*K.shingle_hashes(wh, first)).items():
                    own = shingle_texts(texts[row].as_py())
                    keep[lo + row] = not any(
                        len(items.shingles[i] & own) >= _need(len(items.shingles[i])) for i in hits)
            yield batch.filter(pa.array(keep))
    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item; nothing is shuffled.

    Rows with null or blank texts stay, and so do all columns.
    """
    for index in _indexes(benchmark, slice_bytes):
        docs = docs.mapInArrow(_filter(index), docs.schema)
    return docs
