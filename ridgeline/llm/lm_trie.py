"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is a trigram one (``order`` 3) or a bigram one (2).  The bigrams are smoothed
by a Dirichlet prior on the unigram model:

    P(w | u) = (c(u, w) + m(u) P1(w)) / (c(u) + m(u)),    P1(w) = (c(w) - D) / N

An unknown word gets the mass D V / N that the discount D frees; ``m(u)`` is
``PRIOR`` times u's own training count, to half a doubling, plus a constant, so
frequent contexts keep a share for words they were never seen before.  The trigrams
are smoothed likewise by the bigrams, with a constant mass M:

    P(w | v u) = (c(v, u, w) + M P(w | u)) / (c(v, u) + M)

A context that was never seen leaves P(w | u) as it is.  The trie is the reversed one: words on the first level, below each word
the contexts that precede it, with the quantised log of ``c(u, w) + m(u) P1(w)``.
All else in the formula is a sum over single words, so a token needs its word's
part of the trie only.  Trigrams are one more level below each word, with the log of
``c(v, u, w) + M P(w | u)``; the log of ``c(v, u) + M`` lies with u, at its context v.

1. One pass over the texts counts training tokens into a sketch (a megabyte of
   slots, whatever the corpus) and N; a second counts the frequent words, which the
   sketch only preselects.
2. Every other context, with the shards of the words after it, goes to a shard of
   its own, where it is counted; its count goes on to those shards.
3. Each chunk of documents sends its tokens, as (word, context id, document), to
   the shard of the word; a very frequent word has several, dealt by context.
4. A shard counts its training tokens, writes its trie to a memory-mapped file and
   looks up all its tokens; it answers with sums for each document of a chunk.
5. The sums of a chunk are added up over the shards.

Shards grow in number with the corpus, not in size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .elias_fano import MappedTrie
from .shared import materialise

SKETCH_BITS = 18
SHARD_TOKENS = 3_000_000
CHUNK_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
CHUNK_ROWS = 60_000
CONTEXT_BITS = 40
HOT_TOKENS = 1_000_000
FREQUENT = 1000
MAX_HOT = 1 << 20
DISCOUNT, PRIOR, PRIOR_FLOOR = 0.75, 0.5, 50.0
LONGER_PRIOR = 50.0
LOOKUPS = 250_000
#: In the code of a context that is not in the list of frequent words: 7 more bits of its hash follow.
RARE = 128
#: Hashes of the end of a text and of the context before its first word.
END, BEGIN = K.mix(np.array([0x51ED270B1F1D3A2B, 0x2545F4914F6CDD1D], np.uint64))


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, first token of each row + total): the words, then one end.

    Texts are cut into words a few megabytes at a time; only the hashes of all are held."""
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for lo, hi in K.text_chunks(pa.RecordBatch.from_arrays([col], names=["text"]), limit=PIECE_BYTES):
        wh, first = K.word_hashes(col.slice(lo, hi - lo))
        hashes.append(np.insert(wh, first[1:], END))
        sizes.append(np.diff(first) + 1)
    return np.concatenate(hashes), np.cumsum(np.concatenate(sizes))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


# -- pass 1: sketch and totals; pass 2: frequent words ------------------------------

_SKETCH = "part int, counts binary, tokens long, docs long"
_PARTS = 8


@K.released
def _sketch(batches):
    counts, total, docs = np.zeros(1 << SKETCH_BITS, np.int64), 0, 0
    for batch in batches:
        batch = batch.filter(batch.column("train"))
        for lo, hi in K.text_chunks(batch, limit=4 << 20):
            h, _ = tokens(batch.column("text").slice(lo, hi - lo))
            counts += np.bincount(_slot(h), minlength=1 << SKETCH_BITS)
            total += len(h)
            docs += hi - lo
    pieces = np.split(counts.astype(np.uint32), _PARTS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(_PARTS), pa.int32()), pa.array([p.tobytes() for p in pieces]),
         pa.array([total] + [0] * (_PARTS - 1), pa.int64()), pa.array([docs] + [0] * (_PARTS - 1), pa.int64())],
        names=["part", "counts", "tokens", "docs"])


@K.released
def _add_sketch(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, total, docs = np.zeros((1 << SKETCH_BITS) // _PARTS, np.int64), 0, 0
    for b in batches:
        for blob in b.column("counts"):
            counts += np.frombuffer(blob.as_py(), np.uint32)
        total += int(b.column("tokens").to_numpy().sum())
        docs += int(b.column("docs").to_numpy().sum())
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([counts.tobytes()]),
                                      pa.array([total], pa.int64()), pa.array([docs], pa.int64())],
                                     names=["part", "counts", "tokens", "docs"])


def _count_hot(shared):
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    @K.released
    def run(batches):
        hot = shared.value
        seen: dict[int, int] = {}
        for batch in batches:
            batch = batch.filter(batch.column("train"))
            for lo, hi in K.text_chunks(batch, limit=4 << 20):
                h, _ = tokens(batch.column("text").slice(lo, hi - lo))
                word, n = np.unique(h[hot[_slot(h)]], return_counts=True)
                for w, c in zip(K.to_signed(word).tolist(), n.tolist(), strict=True):
                    seen[w] = seen.get(w, 0) + c
                if len(seen) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()),
                                                      pa.array(list(seen.values()), pa.int64())], schema=schema)
                    seen = {}
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         schema=schema)
    return run


@dataclass
class Statistics:
    """What every task needs: bounded in size by the slots of the sketch and by MAX_HOT."""
    total: int                  # N
    docs: int                   # training documents
    hot: np.ndarray             # sorted hashes of frequent words
    hot_counts: np.ndarray
    hot_fan: np.ndarray         # shards of each
    shards: int
    order: int = 2

    def prior(self, code: np.ndarray) -> np.ndarray:
        """m(u) from a context's code."""
        return PRIOR * np.exp2(code.astype(float) / 2) + PRIOR_FLOOR

    def listed(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each word is in the list of frequent words, its count if so)"""
        if not len(self.hot):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return self.hot[at] == h, self.hot_counts[at]

    def fan(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.ones(len(h), np.uint64)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return np.where(self.hot[at] == h, self.hot_fan[at], 1).astype(np.uint64)


def codes(count: np.ndarray) -> np.ndarray:
    """Half doublings of each count; 0 for 0.  Below ``RARE``."""
    return np.round(2 * np.log2(np.maximum(count, 1))).astype(np.uint8)


def statistics(rows: DataFrame) -> Statistics:
    """Counts over all rows (text, train)."""
    spark = rows.sparkSession
    parts = rows.mapInArrow(_sketch, _SKETCH).groupBy("part").applyInArrow(_add_sketch, _SKETCH).collect()
    sketch, total, docs = np.zeros(1 << SKETCH_BITS, np.int64), 0, 0
    width = len(sketch) // _PARTS
    for r in parts:
        sketch[r.part * width:(r.part + 1) * width] = np.frombuffer(r.counts, np.int64)
        total, docs = total + r.tokens, docs + r.docs
    bound = max(min(FREQUENT, HOT_TOKENS), 4 * total // len(sketch))
    hot_slots = sketch >= bound
    if hot_slots.any():
        # a bounded list: at most a quarter of the slots or total / HOT_TOKENS words, never more than MAX_HOT
        found = (rows.mapInArrow(_count_hot(spark.sparkContext.broadcast(hot_slots)), "word long, n long")
                 .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min(bound, HOT_TOKENS))
                 .orderBy(F.desc("n"), "word").limit(MAX_HOT).collect())
    else:
        found = []
    word = np.array([r.word for r in found], np.int64).view(np.uint64)
    n = np.array([r.n for r in found], np.int64)
    order = np.argsort(word)
    fan = np.where(n >= HOT_TOKENS, -(-n // (HOT_TOKENS // 2)), 1)
    return Statistics(total, docs, word[order], n[order], fan[order],
                      max(spark.sparkContext.defaultParallelism, -(-total // SHARD_TOKENS)))


def _planes(a: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: long runs for the shuffle's compression."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


# -- the shard of each token --------------------------------------------------------

def _longer(before: np.ndarray, context: np.ndarray, first: np.ndarray) -> np.ndarray:
    """3 bytes for each token: bits of the hash of the two words before it."""
    out = np.empty((len(before), 3), np.uint8)
    begins = np.zeros(len(before), bool)
    begins[first[:-1]] = True
    for k in range(0, len(before), LOOKUPS):
        at = slice(k, k + LOOKUPS)
        second = np.empty(len(before[at]), np.uint64)
        second[1:] = before[at][:-1]
        second[0] = before[k - 1] if k else BEGIN
        second[begins[at]] = BEGIN
        h = (K.mix(context[at] + second * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype("<u4")
        out[at] = h.view(np.uint8).reshape(-1, 4)[:, :3]
    return out


def _placed(text: pa.Array, stats: Statistics):
    """(word, word before, context hash, shard) of every token, and the first token of each row + total"""
    h, first = tokens(text)
    before = np.empty(len(h), np.uint64)
    before[1:] = h[:-1]
    before[first[:-1]] = BEGIN
    context, shard = np.empty(len(h), np.uint64), np.empty(len(h), np.int32)
    for k in range(0, len(h), LOOKUPS):
        part = slice(k, k + LOOKUPS)
        context[part] = K.mix(before[part])
        sub = (context[part] >> np.uint64(8)) % stats.fan(h[part])
        shard[part] = K.mix(h[part] + sub * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(stats.shards)
    return h, before, context, shard, first


def _rare_id(context: np.ndarray) -> np.ndarray:
    """The byte that takes the place of a rare context's code: 7 bits of its hash above the 32 that are sent."""
    return ((context >> np.uint64(32)).astype(np.uint8) & np.uint8(RARE - 1)) | np.uint8(RARE)


# -- pass 3: counts of the rare contexts to the shards of the words after them ------

_CONTEXTS = "home long, contexts binary, sizes binary, shards binary, counts binary"


def _list_contexts(shared):
    schema = pa.schema([("home", pa.int64())] + [(b, pa.binary()) for b in ("contexts", "sizes", "shards", "counts")])

    @K.released
    def run(batches):
        stats = shared.value
        for batch in batches:
            for lo, hi in K.text_chunks(batch, limit=CHUNK_BYTES):
                yield from _batched(_contexts_of(batch.slice(lo, hi - lo), stats), schema)
    return run


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 64) -> Iterator[pa.RecordBatch]:
    """The rows as they come, ``size`` to a batch."""
    while held := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
                                         schema=schema)


def _contexts_of(part: pa.RecordBatch, stats: Statistics):
    """For each home shard: its contexts, the shards each was seen for, and training tokens of each pair."""
    _, before, context, shard, first = _placed(part.column("text"), stats)
    train = np.repeat(part.column("train").to_numpy(zero_copy_only=False), np.diff(first))
    rare = before != BEGIN
    for k in range(0, len(before), LOOKUPS):
        rare[k:k + LOOKUPS] &= ~stats.listed(before[k:k + LOOKUPS])[0]
    context, shard, train = context[rare], shard[rare], train[rare]
    del before, rare
    if not len(context):
        return
    home = (K.mix(context) % np.uint64(stats.shards)).astype(np.int32)
    order = np.lexsort((shard, context, home))
    context, shard, train, home = context[order], shard[order], train[order], home[order]
    pair = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])]))
    n = np.add.reduceat(train.astype(np.uint32), pair, dtype=np.uint32)
    context, shard, home = context[pair], shard[pair].astype(np.uint32), home[pair]
    edges = [0, *(np.flatnonzero(np.diff(home)) + 1).tolist(), len(home)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        at = np.flatnonzero(np.concatenate([[True], context[lo + 1:hi] != context[lo:hi - 1]]))
        yield (int(home[lo]), context[lo:hi][at].tobytes(), _planes(np.diff(np.append(at, hi - lo)).astype(np.uint32)),
               _planes(shard[lo:hi]), _planes(n[lo:hi]))


@K.released
def _count_contexts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The home shard's contexts with their counts, once for each shard they were seen for."""
    parts = []
    for b in batches:
        for r in b.to_pylist():
            of = np.repeat(np.frombuffer(r["contexts"], np.uint64), _from_planes(r["sizes"], np.uint32).astype(np.int64))
            parts.append((of, _from_planes(r["shards"], np.uint32), _from_planes(r["counts"], np.uint32)))
    context, shard, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    known, of = np.unique(context, return_inverse=True)
    n = np.bincount(of, n, len(known)).astype(np.uint32)[of]
    order = np.lexsort((context, shard))
    context, shard, n = context[order], shard[order], n[order]
    new = np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])])
    context, shard, n = context[new], shard[new], n[new]
    edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    rows = ((int(shard[lo]), None, None, None, context[lo:hi].astype(np.uint32).tobytes(), _rare_id(context[lo:hi]).tobytes(),
             None, None, None, None, _planes(n[lo:hi]), None) for lo, hi in zip(edges[:-1], edges[1:], strict=True))
    yield from _batched(rows, _TOKENS_ARROW, 1024)


# -- pass 4: tokens to shards -------------------------------------------------------

_TOKENS = ("shard long, chunk long, words binary, sizes binary, hash binary, code binary, doc binary, train binary, "
           "ids binary, lengths binary, held binary, longer binary")
_BLOBS = ("words", "sizes", "hash", "code", "doc", "train", "ids", "lengths", "held", "longer")
_TOKENS_ARROW = pa.schema([("shard", pa.int64()), ("chunk", pa.int64())] + [(b, pa.binary()) for b in _BLOBS])


def _deal(shared):
    schema = _TOKENS_ARROW

    @K.released
    def run(batches):
        stats, number = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in K.text_chunks(batch, limit=CHUNK_BYTES):
                for at in range(lo, hi, CHUNK_ROWS):
                    part = batch.slice(at, min(CHUNK_ROWS, hi - at))
                    yield from _batched(_chunk(part, stats, number), schema)
                    number += 1
    return run


def _chunk(part: pa.RecordBatch, stats: Statistics, number: int):
    h, before, context, shard, first = _placed(part.column("text"), stats)
    size = np.diff(first)
    train = part.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
    ids = part.column("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    held = part.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint8)
    # the chunk's documents travel apart, with a shard number below 0
    yield (-1 - number % stats.shards, number, None, None, None, None, known.tobytes(), None,
           ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), size.astype(np.int64).tobytes(), held.tobytes(), None)
    doc = np.repeat(np.arange(len(size), dtype=np.uint16), size)
    code = _rare_id(context)
    for k in range(0, len(h), LOOKUPS):
        at = slice(k, k + LOOKUPS)
        frequent, count = stats.listed(before[at])
        begin = before[at] == BEGIN
        count[begin] = stats.docs
        code[at] = np.where(frequent | begin, codes(count), code[at])
    longer = _longer(before, context, first) if stats.order > 2 else None
    del before
    context = context.astype(np.uint32)
    order = np.lexsort((h, shard))
    h, shard, doc, context, code = h[order], shard[order], doc[order], context[order], code[order]
    longer = longer[order] if longer is not None else None
    del order
    edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(h)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        new = np.concatenate([[True], h[lo + 1:hi] != h[lo:hi - 1]])
        at = np.flatnonzero(new)
        yield (int(shard[lo]), number, h[lo:hi][at].tobytes(), _planes(np.diff(np.append(at, hi - lo)).astype(np.uint32)),
               context[lo:hi].tobytes(), code[lo:hi].tobytes(), _planes(doc[lo:hi]),
               np.packbits(train).tobytes(), None, None, None, longer[lo:hi].tobytes() if longer is not None else None)


# -- one shard: count, build, look up -----------------------------------------------

_SUMS = "chunk long, kind string, doc binary, base binary, score binary, known binary, types long"


def _row(chunk, kind, doc=None, base=None, score=None, known=None, types=0):
    return (chunk, kind, doc, base, score, known, types)


def _emit(rows):
    schema = pa.schema([("chunk", pa.int64()), ("kind", pa.string())]
                       + [(b, pa.binary()) for b in ("doc", "base", "score", "known")] + [("types", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def _shard(shared):
    @K.released
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = shared.value
        if key[0].as_py() < 0:
            for b in batches:
                yield _emit([_row(r["chunk"], "docs", r["doc"], r["ids"], r["lengths"], r["held"]) for r in b.to_pylist()])
            return
        rows, tables = [], []
        for b in batches:
            for r in b.select(["chunk", "words", "sizes", "hash", "code", "doc", "train", "held", "longer"]).to_pylist():
                if r["chunk"] is None:
                    tables.append((_context_ids(r), _from_planes(r["held"], np.uint32)))
                else:
                    rows.append(r)
        seen = _resolve(rows, tables, stats)
        del tables
        trie = _build(rows, stats, seen)
        try:
            new = ~np.isin(trie_words := _all_words(trie), stats.hot)
            yield _emit([_row(None, "types", types=int(new.sum()))])
            del trie_words
            for r in rows:
                yield _emit([_answer(r, trie, stats, seen)])
        finally:
            trie.close()
    return run


def _all_words(trie: MappedTrie) -> np.ndarray:
    if not trie.words.n:
        return np.zeros(0, np.uint64)
    return trie.words.access(np.arange(trie.words.n)) << np.uint64(1) | trie.odd.astype(np.uint64)


def _context_ids(r) -> np.ndarray:
    """Hash above, frequency code below."""
    return np.frombuffer(r["hash"], np.uint32).astype(np.uint64) << np.uint64(8) | np.frombuffer(r["code"], np.uint8).astype(np.uint64)


def _resolve(rows, tables, stats: Statistics) -> np.ndarray:
    """Training counts of the contexts, which the list of frequent words and ``tables`` give; ``rows`` get the
    place of each token's context among them, and its code."""
    n = np.append(stats.hot_counts, stats.docs)
    ids = K.mix(np.append(stats.hot, BEGIN)).astype(np.uint32).astype(np.uint64) << np.uint64(8) | codes(n)
    if tables:
        rare, count = (np.concatenate(c) for c in zip(*tables, strict=True))
        ids, n = np.append(ids, rare), np.append(n, count)
    order = np.argsort(ids)
    ids, n = ids[order], n[order].astype(np.int64)
    code = codes(n)
    for r in rows:
        r["place"] = np.searchsorted(ids, _context_ids(r)).astype(np.int32)
        r["code"] = code[r["place"]].tobytes()
    return n


def _longer_ids(r, context: np.ndarray) -> np.ndarray:
    """Ids of the contexts of two words: 24 bits of their hash above, 16 of the second's below."""
    h = np.frombuffer(r["longer"], np.uint8).reshape(-1, 3).astype(np.uint64)
    h = h[:, 0] | h[:, 1] << np.uint64(8) | h[:, 2] << np.uint64(16)
    return h << np.uint64(16) | context >> np.uint64(8) & np.uint64(0xFFFF)


def _unpack(r):
    words, sizes = np.frombuffer(r["words"], np.uint64), _from_planes(r["sizes"], np.uint32).astype(np.int64)
    doc = _from_planes(r["doc"], np.uint16).astype(np.int64)
    return words, sizes, _context_ids(r), doc


def _build(rows, stats: Statistics, seen: np.ndarray) -> MappedTrie:
    """The trie of the shard's training tokens."""
    words = np.unique(np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows]))
    keys, longer, place = [], [], []
    for r in rows:
        own, sizes, context, doc = _unpack(r)
        number = np.repeat(np.searchsorted(words, own).astype(np.uint64), sizes)
        train = np.unpackbits(np.frombuffer(r["train"], np.uint8)).astype(bool)[doc]
        keys.append((number[train] << np.uint64(CONTEXT_BITS)) | context[train])
        if stats.order > 2:
            longer.append((number[train] << np.uint64(CONTEXT_BITS)) | _longer_ids(r, context)[train])
            place.append(r["place"][train])
    keys = np.concatenate(keys)
    if stats.order > 2:
        longer = np.concatenate(longer)
        order = np.argsort(longer)
        longer = longer[order]
        new = np.flatnonzero(np.concatenate([[True], longer[1:] != longer[:-1]])) if len(longer) else np.zeros(0, np.int64)
        longer_n, longer_of = np.diff(np.append(new, len(longer))).astype(np.int32), order[new].astype(np.int32)
        longer = longer[new]
        order = np.argsort(keys)
        keys = keys[order]
    else:
        keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    entries, n = keys[new], np.diff(np.append(new, len(keys))).astype(np.int32)
    if stats.order > 2:
        place = np.concatenate(place)[order[new]]                       # of each bigram's context
        bigram = np.empty(len(keys), np.int32)                          # of each token
        bigram[order] = np.repeat(np.arange(len(new), dtype=np.int32), n)
        longer_of = bigram[longer_of]                                   # the bigram in each trigram
        del order, bigram
    del keys, new
    word = (entries >> np.uint64(CONTEXT_BITS)).astype(np.int32)
    counts = np.bincount(word, n, len(words)).astype(np.int64)
    kept = counts > 0                   # words of held-out texts only are unknown
    words, counts = words[kept], counts[kept]
    word = (np.cumsum(kept) - 1).astype(np.int32)[word]
    entries &= np.uint64((1 << CONTEXT_BITS) - 1)
    entries |= word.astype(np.uint64) << np.uint64(CONTEXT_BITS)
    counts = np.where(*stats.listed(words), counts)     # a frequent word may have part of its contexts here
    values = np.zeros(len(n), np.float32)
    for k in range(0, len(n), LOOKUPS):
        prior = stats.prior(entries[k:k + LOOKUPS] & np.uint64(255))
        values[k:k + LOOKUPS] = np.log10(n[k:k + LOOKUPS] + prior * (counts[word[k:k + LOOKUPS]] - DISCOUNT) / stats.total)
    if stats.order == 2:
        del word, n
        return MappedTrie(words, counts, entries, values, CONTEXT_BITS)
    weights = np.log10(n + LONGER_PRIOR).astype(np.float32)
    del n
    bigram = np.zeros(len(values), np.float32)
    for k in range(0, len(values), LOOKUPS):
        prior = stats.prior(entries[k:k + LOOKUPS] & np.uint64(255))
        bigram[k:k + LOOKUPS] = 10 ** values[k:k + LOOKUPS].astype(float) / (seen[place[k:k + LOOKUPS]] + prior)
    longer_values = np.log10(longer_n + np.float32(LONGER_PRIOR) * bigram[longer_of]).astype(np.float32)
    del bigram, place
    longer &= np.uint64((1 << CONTEXT_BITS) - 1)
    longer |= word[longer_of].astype(np.uint64) << np.uint64(CONTEXT_BITS)
    del word, longer_of, longer_n
    return MappedTrie(words, counts, entries, values, CONTEXT_BITS, weights, (longer, longer_values))


def _answer(r, trie: MappedTrie, stats: Statistics, seen: np.ndarray):
    """Sums for each document of one chunk over the tokens that are in this shard."""
    words, sizes, context, doc = _unpack(r)
    number = trie.find_words(words)
    there = number >= 0
    count = np.where(there, trie.counts[number] if trie.words.n else 0, 0)
    count = np.where(*stats.listed(words), count)       # a frequent word may have no training context in this shard
    first, end = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    if there.any():
        first[there], end[there] = trie.ranges(number[there])
    of = np.repeat(np.arange(len(words)), sizes)
    prior = stats.prior(context & np.uint64(255))
    unigram = np.where(count > 0, np.log10(np.maximum(count - DISCOUNT, 1e-9) / max(stats.total, 1)), 0.0)
    score = np.log10(prior) + unigram[of]               # an unknown word's unigram part is added at the end
    look = np.flatnonzero(there[of])
    if stats.order == 2:
        for k in range(0, len(look), LOOKUPS):
            at = look[k:k + LOOKUPS]
            w = of[at]
            found = trie.find(first[w], end[w], context[at])
            score[at] = np.where(np.isnan(found), score[at], found)
        # each word is also the next token's context; the end is nobody's
        as_context = np.where(words == END, 0.0, np.log10(count + stats.prior(codes(count))))[of]
    else:
        longer = _longer_ids(r, context)
        # each word is, with the word before it, also the next token's context
        as_context = np.full(len(of), np.log10(LONGER_PRIOR))
        below = np.log10(LONGER_PRIOR) - np.log10(seen[r["place"]] + prior)
        score += below
        first3, end3 = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if there.any():
            first3[there], end3[there] = trie.ranges(number[there], 1)
        for k in range(0, len(look), LOOKUPS):
            at = look[k:k + LOOKUPS]
            w = of[at]
            place = trie.places(first[w], end[w], context[at])
            at, w, place = at[place >= 0], w[place >= 0], place[place >= 0]
            found = trie.find(first3[w], end3[w], longer[at], 1)
            score[at] = np.where(np.isnan(found), trie.centres[0][trie.codes[0][place]] + below[at], found)
            as_context[at] = trie.weight(place)
        as_context[(words == END)[of]] = 0.0
    score -= as_context
    docs, at = np.unique(doc, return_inverse=True)
    known = count[of] > 0
    total = lambda v: np.bincount(at, v, len(docs))
    return _row(r["chunk"], "sums", docs.astype(np.uint16).tobytes(), total(np.log10(count + 1.0)[of]).tobytes(),
                total(score).astype(np.float32).tobytes(), total(known).astype(np.uint32).tobytes())


# -- sums of a chunk ----------------------------------------------------------------

_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, score_sum double"


@K.released
def _gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = None
    sums: list = []
    for b in batches:
        for r in b.to_pylist():
            if r["kind"] == "docs":
                ids = np.frombuffer(r["base"], np.int64)
                size, held = np.frombuffer(r["score"], np.int64), np.frombuffer(r["known"], np.uint8).astype(bool)
                named = np.frombuffer(r["doc"], np.uint8).astype(bool)
            else:
                sums.append((np.frombuffer(r["doc"], np.uint16).astype(np.int64), np.frombuffer(r["base"], float),
                             np.frombuffer(r["score"], np.float32), np.frombuffer(r["known"], np.uint32)))
    base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    for doc, b, s, k in sums:
        base[doc] += b
        score[doc] += s
        known[doc] += k
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=~named), pa.array(held), pa.array(size), pa.array(known), pa.array(base), pa.array(score)],
        names=["doc_id", "held_out", "n_tokens", "n_known", "base_sum", "score_sum"])


def score_texts(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    ``docs`` (doc_id, text, ...); rows where ``held_out`` holds are scored only, the others
    are learned from as well.  A null or empty text is its end alone.  Ids may be null
    or repeat (each row is a text of its own; a null ``held_out`` counts as false);
    other columns are ignored.  Without any training row, every token is unknown and
    the model's score is 0 times the number of tokens; an empty table gives an empty result.
    ``order`` is 2 or 3.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3 expected")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    rows = rows.withColumn("train", ~F.col("held_out"))
    stats = statistics(rows)
    stats.order = order
    shared = spark.sparkContext.broadcast(stats)
    counted = rows.mapInArrow(_list_contexts(shared), _CONTEXTS).groupBy("home").applyInArrow(_count_contexts, _TOKENS)
    dealt = rows.mapInArrow(_deal(shared), _TOKENS).union(counted)
    sums = dealt.groupBy("shard").applyInArrow(_shard(shared), _SUMS)
    sums = materialise(sums, "lm-sums")
    types = (sums.where("kind = 'types'").agg(F.sum("types")).first()[0] or 0) + int((stats.hot_counts > 0).sum())
    n = stats.total
    out = sums.where("kind <> 'types'").groupBy("chunk").applyInArrow(_gather, _RESULT)
    begin = LONGER_PRIOR if order > 2 else stats.prior(codes(np.array([stats.docs])))[0]
    first = float(np.log10(stats.docs + begin))
    unknown = float(np.log10(DISCOUNT * types / n)) if n else 0.0
    score = F.col("score_sum") + (F.col("n_tokens") - F.col("n_known")) * unknown - first
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base_sum") - F.col("n_tokens") * float(np.log10(n + types + 1.0))).alias("base_score"),
                      (score if n else F.lit(0.0)).alias("score"))
