"""Order-preserving packing of token streams into sequences by dynamic programming.

The documents of a partition form one stream of tokens, in order.  A window is the
tokens between two cuts, at most ``LENGTH`` of them; cuts may stand at document
ends, at sentence ends and, within a sentence longer than ``STRIDE`` tokens, every
``STRIDE`` tokens.  A window costs its padding (none where its length is a power of
two), a little for being a sequence at all, and a penalty where it cuts a document
(more inside a sentence).  The cheapest cuts are found in one pass: for a padded
window the cost is ``best[i] + cut[i]`` plus terms of the end only, so the best
start is the minimum over a sliding window, which a monotone queue holds; windows
of a power of two are single look-ups.

Token ids are those of the tokenizer for the whole text.  Its pieces never cross
white space, so each distinct word of a few megabytes of text is encoded once.  The stream is solved in segments of about ``SEGMENT``
tokens; the windows near a segment's end are left for the next one.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .word_bpe import WordBpe, take

TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
SEGMENT = 1 << 19
STRIDE = 256
GAP = 32
SEQUENCE_COST, SENTENCE_COST, INSIDE_COST = 24, 16, 256
POWERS = tuple(1 << k for k in range(6, 12))
CHUNK = 4 << 20


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def encode(texts: pa.Array, bpe: WordBpe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all the texts, first id of each text + total, positions after which a sentence ends).

    Each distinct word of the array is encoded once; the end ids are not among the ids.
    """
    raw, starts, ends, first = K.words(texts, lower=False)
    _, example, rows = np.unique(K.hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
    known, size = bpe.encode(raw, starts[example], ends[example])
    ids, width = take(known, np.cumsum(size) - size, size, rows)
    upto = np.concatenate([[0], np.cumsum(width)])
    final = np.isin(raw[ends - 1], np.frombuffer(b".!?", np.uint8)) if len(ends) else np.zeros(0, bool)
    return ids.astype(np.uint32), upto[first], upto[1:][final]


def cut_points(docs: list[tuple[int, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Allowed cuts of a stream and their penalties, from (tokens, sentence ends) of its documents."""
    cuts, cost, base = [0], [0], 0
    for n, stops in docs:
        last = base
        for stop in [int(s) for s in stops] + [n]:
            at = base + stop
            while at - last > STRIDE + GAP:
                last += STRIDE
                cuts.append(last)
                cost.append(INSIDE_COST)
            if stop < n and at - last >= GAP and n - stop >= GAP:
                cuts.append(at)
                cost.append(SENTENCE_COST)
                last = at
        base += n
        if cuts[-1] != base:
            cuts.append(base)
            cost.append(0)
        else:
            cost[-1] = 0
    return cuts, cost


def best_windows(cuts: list[int], cost: list[int]) -> list[int]:
    """The cheapest windows over all the cuts: their ends, as indexes into ``cuts``."""
    where = {c: k for k, c in enumerate(cuts)}
    best, origin, queue, keys = [0.0], [0], deque([0]), [0.0]
    for j in range(1, len(cuts)):
        end = cuts[j]
        while end - cuts[queue[0]] > LENGTH:
            queue.popleft()
        i = queue[0]
        low, start = keys[i] + LENGTH - end, i
        for p in POWERS:
            k = where.get(end - p)
            if k is not None and best[k] < low:
                low, start = best[k], k
        low += cost[j] + SEQUENCE_COST
        best.append(low)
        origin.append(start)
        key = low + end
        keys.append(key)
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out, j = [], len(cuts) - 1
    while j > 0:
        out.append(j)
        j = origin[j]
    return out[::-1]


class Packer:
    """Takes documents in order and gives rows (doc_id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, first_sequence: int):
        self.sequence, self.docs, self.waiting = first_sequence, [], 0

    def add(self, doc_id, ids: np.ndarray, stops: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, stops, 0, len(ids)))
        self.waiting += len(ids)
        return self.solve(False) if self.waiting >= SEGMENT else []

    def solve(self, final: bool) -> list[tuple]:
        """Windows of what waits; unless ``final``, those in its last eight sequences are left."""
        if not self.docs:
            return []
        cuts, cost = cut_points([(len(ids), stops) for _, ids, stops, _, _ in self.docs])
        ends = [cuts[j] for j in best_windows(cuts, cost)]
        if not final:
            ends = [e for e in ends if e <= cuts[-1] - 8 * LENGTH]
        rows, start, k, base = [], 0, 0, 0      # k: current document, base: where it begins in the stream
        for end in ends:
            offset = 0
            while start < end:
                doc_id, ids, _, skipped, total = self.docs[k]
                upto = min(end, base + len(ids))
                piece = ids[start - base:upto - base]
                rows.append((doc_id, skipped + start - base, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), total,
                             self.sequence, offset))
                offset += len(piece)
                start = upto
                if upto == base + len(ids):
                    base, k = base + len(ids), k + 1
            self.sequence += 1
        left = self.docs[k:]
        if left and start > base:
            doc_id, ids, stops, skipped, total = left[0]
            gone = start - base
            left[0] = (doc_id, ids[gone:], stops[stops > gone] - gone, skipped + gone, total)
        self.docs, self.waiting = left, sum(len(d[1]) for d in left)
        return rows


_FIELDS = (("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()))
_PIECES = ", ".join(f"{n} long" for n, _ in _FIELDS)


def _pack(path):
    schema = pa.schema(list(_FIELDS))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    @K.released
    def run(batches):
        bpe = WordBpe(path or tokenizer_path())
        packer = Packer(TaskContext.get().partitionId() << 36)
        for batch in batches:
            rows = []
            for lo, hi in K.text_chunks(batch, limit=CHUNK):
                ids, first, stops = encode(batch.column("text").slice(lo, hi - lo), bpe)
                at = np.searchsorted(stops, first, "right")
                for k, doc_id in enumerate(batch.column("doc_id").slice(lo, hi - lo).to_pylist()):
                    own = np.append(ids[first[k]:first[k + 1]], np.uint32(END_ID))
                    rows += packer.add(doc_id, own, stops[at[k]:at[k + 1]] - first[k])
            if rows:
                yield batch_of(rows)
        rows = packer.solve(True)
        if rows:
            yield batch_of(rows)
    return run


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each piece of a document (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``docs`` (doc_id, text, ...) are taken in the order of each input partition, without a
    shuffle; sequences never span partitions.  A null or empty text is its end id
    alone.  Ids may be null or repeat (each row is a document of its own); other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(path), _PIECES)
