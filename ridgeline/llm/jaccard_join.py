"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence.

Two documents link when the Jaccard similarity of their sets of five-word
shingles is at least 3/4.  The steps, all over every document:

1. One pass hashes each text to its shingle set.  Documents with equal sets
   (copies) are one class, represented by the smallest id; only representatives
   go on, so copies are never expanded into pairs.
2. A fixed-size count sketch of all shingles gives a common order, rare first.
   In that order only the first ``n - ceil(3n/4) + 1`` shingles of a set of size
   ``n`` can hold the first shared one of a linked pair, so only these enter the
   incidence matrix.
3. Star pairs (each representative against the smallest and the largest id with the
   same band of two min-hashes, for a few bands) are verified exactly and joined to first
   components.  This contracts large groups of near copies in linear work.
4. The incidence matrix is cut into blocks by n-gram.  N-grams that one first
   component alone has are taken out, which leaves for each document how many
   n-grams of its prefix are common with others.  Each block's product gives the
   overlap counts of pairs that are in different first components and whose sizes,
   common n-grams and profiles (counts of n-grams by class of their hash) allow a link, over the n-grams that stand early enough in
   both orders; counts are summed over the blocks, and a pair is dropped when its
   count stays below the bound that its sizes demand.
5. The remaining pairs are verified on their whole sets; the links of 3 and 5
   give the components.

Only hash collisions of 64 bits separate this from a comparison of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .shared import materialise, possible, without

BANDS, BAND_ROWS = 6, 2
SKETCH_BITS = 20
BLOCK_ENTRIES = 2_000_000
PRODUCT_CHUNK = 400_000
HELD_PAIRS = 2_000_000
PAIRS_AT_ONCE = 50_000
PLACES = 65_535
PROFILE = 128
_SEEDS = K.mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _prefix_len(n):
    return n - (3 * n + 3) // 4 + 1


def bounds(na, nb):
    """(needed, early): sets of sizes ``na`` and ``nb`` link only with ``needed`` shared n-grams;
    ``early`` of these then stand, in both orders, where at least ``needed - early + 1`` are left.

    Works on integers, arrays and (as :data:`EARLY_SQL`) columns.
    """
    needed = (3 * (na + nb) + 6) // 7
    spare = needed - (3 * np.maximum(na, nb) + 3) // 4 + 1
    return needed, np.minimum(1 + needed // 64, spare)


EARLY_SQL = ("least(1 + ((3 * (na + nb) + 6) div 7) div 64, "
             "(3 * (na + nb) + 6) div 7 - (3 * greatest(na, nb) + 3) div 4 + 1)")


# -- pass 1: sets, fingerprints, min-hashes, sketch ---------------------------------

_SETS = "doc_id long, n long, fp1 long, fp2 long, mins array<long>, profile binary, part int, counts binary"


def profile(s: np.ndarray) -> np.ndarray:
    """How many n-grams of a set fall into each of ``PROFILE`` classes of their hashes, 255 for more than 254."""
    return np.minimum(np.bincount((s & np.uint64(PROFILE - 1)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8)


def most_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of two tables of profiles how many n-grams the sets can share at most: of each class the smaller
    count.  Where a count may be more than its byte says, there is no bound."""
    open_ = (a.max(axis=1, initial=0) == 255) & (b.max(axis=1, initial=0) == 255)
    return np.where(open_, np.iinfo(np.int64).max, np.minimum(a, b).sum(axis=1, dtype=np.int64))


@K.released
def _sets(batches):
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()),
                        ("mins", pa.list_(pa.int64())), ("profile", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        for lo, hi in K.text_chunks(batch):
            ids = batch.column("doc_id").slice(lo, hi - lo)
            wh, first = K.word_hashes(batch.column("text").slice(lo, hi - lo))
            sh, off = K.shingle_hashes(wh, first)
            n = np.zeros(hi - lo, np.int64)
            fp = np.zeros((2, hi - lo), np.uint64)
            mins = [[] for _ in range(hi - lo)]
            profiles = [b""] * (hi - lo)
            for i in range(hi - lo):
                s = K.distinct_sorted(sh[off[i]:off[i + 1]])
                if not len(s):
                    continue
                n[i] = len(s)
                fp[0, i] = s.sum(dtype=np.uint64)
                fp[1, i] = K.mix(s + _SEEDS[0]).sum(dtype=np.uint64)
                np.add.at(sketch, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                low = [K.mix(s ^ _SEEDS[1 + p]).min() for p in range(BANDS * BAND_ROWS)]
                bands = K.mix(np.array(low[::2], np.uint64) * np.uint64(3) + K.mix(np.array(low[1::2], np.uint64)))
                mins[i] = K.to_signed(bands).tolist()
                profiles[i] = profile(s).tobytes()
            yield pa.RecordBatch.from_arrays([
                ids.cast(pa.int64()), pa.array(n), pa.array(K.to_signed(fp[0])), pa.array(K.to_signed(fp[1])),
                pa.array(mins, pa.list_(pa.int64())), pa.array(profiles, pa.binary()), pa.nulls(hi - lo, pa.int32()),
                pa.nulls(hi - lo, pa.binary()),
            ], schema=schema)
    parts = 16
    pieces = np.split(np.minimum(sketch, 65535).astype(np.uint16), parts)
    none = pa.nulls(parts, pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(parts, pa.list_(pa.int64())), pa.nulls(parts, pa.binary()),
                                      pa.array(range(parts), pa.int32()), pa.array([p.tobytes() for p in pieces])],
                                     schema=schema)


@K.released
def _sum_sketch(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << (SKETCH_BITS - 4), dtype=np.uint64)
    for b in batches:
        for blob in b.column("counts"):
            total += np.frombuffer(blob.as_py(), np.uint16)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])],
                                     names=["part", "counts"])


def shingle_levels(sets: DataFrame) -> np.ndarray:
    """Frequency level of each of the 2^20 sketch slots: 0 for an ordinary count, else
    the doublings above twice the mean.  One megabyte, whatever the input size."""
    rows = (sets.where("part is not null").select("part", "counts").groupBy("part")
            .applyInArrow(_sum_sketch, "part int, counts binary").collect())
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.float64)
    width = 1 << (SKETCH_BITS - 4)
    for r in rows:
        counts[r.part * width:(r.part + 1) * width] = np.frombuffer(r.counts, np.uint64)
    mean = max(counts.mean(), 4.0)
    with np.errstate(divide="ignore"):
        level = np.floor(np.log2(np.maximum(counts, 1e-9) / (2 * mean))) + 1
    return np.clip(level, 0, 31).astype(np.uint8)


# -- pass 2: the prefix of each set, cut into blocks --------------------------------

_PREFIX = "doc_id long, n long, last long, prefix binary"


def _prefixes(levels):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("prefix", pa.binary())])

    @K.released
    def run(batches):
        level = levels.value
        for batch in batches:
            for lo, hi in K.text_chunks(batch):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                wh, first = K.word_hashes(batch.column("text").slice(lo, hi - lo))
                sh, off = K.shingle_hashes(wh, first)
                slot = (sh >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                # order key: level above 58 bits of the hash; stays positive as a signed long
                key = (level[slot].astype(np.uint64) << np.uint64(58)) | (sh >> np.uint64(6))
                n, last, blob = [], [], []
                for i in range(hi - lo):
                    s = K.distinct_sorted(key[off[i]:off[i + 1]])
                    p = _prefix_len(len(s)) if len(s) else 0
                    n.append(len(s))
                    last.append(int(s[p - 1]) if p else 0)
                    blob.append(s[:p].tobytes())
                yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(last, pa.int64()),
                                                  pa.array(blob, pa.binary())], schema=schema)
    return run


_ENTRIES = "block long, doc_id long, comp long, n long, last long, keys binary, places binary"


def _to_blocks(blocks):
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("comp", pa.int64()), ("n", pa.int64()),
                        ("last", pa.int64()), ("keys", pa.binary()), ("places", pa.binary())])

    @K.released
    def run(batches):
        for batch in batches:
            ids, comp = batch.column("doc_id").to_numpy(), batch.column("comp").to_numpy()
            n, last, prefixes = batch.column("n").to_numpy(), batch.column("last").to_numpy(), batch.column("prefix")
            for at in range(0, batch.num_rows, 512):
                rows, block, keys, places = [], [], [], []
                for i in range(at, min(at + 512, batch.num_rows)):
                    k = np.frombuffer(prefixes[i].as_buffer(), np.uint64)
                    b = K.mix(k) % np.uint64(blocks)
                    order = np.argsort(b, kind="stable")
                    k, b = k[order], b[order]
                    place = np.minimum(order, PLACES).astype(np.uint16)
                    edges = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(k)]
                    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                        rows.append(i)
                        block.append(int(b[lo]))
                        keys.append(k[lo:hi].tobytes())
                        places.append(place[lo:hi].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(ids[rows]), pa.array(comp[rows]),
                                                  pa.array(n[rows]), pa.array(last[rows]), pa.array(keys, pa.binary()),
                                                  pa.array(places, pa.binary())], schema=schema)
    return run


# -- the product of one block -------------------------------------------------------

_PAIRS = "a long, b long, na long, nb long, shared long"


def shared_entries(comp, row, keys):
    """Numbers of the entries whose n-gram occurs in two first components or more, in the order of
    (n-gram, component).  The others make no pair."""
    order = np.lexsort((comp[row], keys))
    if not len(order):
        return order
    sorted_keys, own = keys[order], comp[row[order]]
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    last = np.append(at[1:], len(order)) - 1
    return order[np.repeat(own[at] != own[last], last - at + 1)]


def block_product(doc, comp, n, last, common, row, keys, place, profiles):
    """Overlap counts of one block: batches of (a, b, na, nb, shared).

    ``doc``, ``comp``, ``n``, ``last`` and ``common`` describe the block's documents (id,
    first component, set size, the prefix's last n-gram, and how many n-grams of the
    prefix other components have in theirs); entry i says that document number ``row[i]`` has n-gram ``keys[i]`` as number
    ``place[i]`` of its order.  Pairs are of different components, and their sizes must
    allow a link: only n-grams that stand early enough in both orders count (see
    :func:`bounds`), and for the document whose prefix ends first (what it shares there
    is in the other's prefix too), what is common in the prefix plus all behind it
    must reach the overlap that is needed.  So must the overlap that the documents' ``profiles`` (see
    :func:`most_shared`) leave room for.
    """
    order = shared_entries(comp, row, keys)
    row, keys, place = row[order], keys[order], place[order]
    m = len(keys)
    if m < 2:
        return
    reach = common + (3 * n + 3) // 4 - 1
    run_new = np.concatenate([[True], keys[1:] != keys[:-1]])
    own = comp[row]
    comp_new = run_new | np.concatenate([[True], own[1:] != own[:-1]])
    run_at, comp_at = np.flatnonzero(run_new), np.flatnonzero(comp_new)
    run_end = np.append(run_at[1:], m)[np.cumsum(run_new) - 1]
    comp_end = np.append(comp_at[1:], m)[np.cumsum(comp_new) - 1]
    width = run_end - comp_end                    # later entries of the n-gram, other component
    entry = np.flatnonzero(width)
    ends = np.cumsum(width[entry])
    size = n[row]
    pairs, counts, held = [], [], 0

    def flush():
        pair, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        shared = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
        a, b = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return doc[a], doc[b], n[a], n[b], shared

    at = 0
    while at < len(entry):
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + PRODUCT_CHUNK, side="right")))
        e = entry[at:stop]
        w = width[e]
        at = stop
        left = np.repeat(e, w)
        right = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(comp_end[e], w)
        nl, nr = size[left], size[right]
        room = np.minimum(nl - place[left], nr - place[right])      # n-grams left from here on
        needed, early = bounds(nl, nr)
        fits = ((4 * np.minimum(nl, nr) >= 3 * np.maximum(nl, nr)) & (room > needed - early)
                & (np.where(last[row[left]] <= last[row[right]], reach[row[left]], reach[row[right]]) >= needed))
        left, right = row[left[fits]], row[right[fits]]
        if not len(left):
            continue
        swap = doc[left] > doc[right]
        low, high = np.where(swap, right, left).astype(np.uint64), np.where(swap, left, right).astype(np.uint64)
        pair, count = np.unique(low << np.uint64(32) | high, return_counts=True)
        can = np.empty(len(pair), bool)
        for k in range(0, len(pair), PAIRS_AT_ONCE):
            part = pair[k:k + PAIRS_AT_ONCE]
            a, b = (part >> np.uint64(32)).astype(np.int64), (part & np.uint64(0xFFFFFFFF)).astype(np.int64)
            can[k:k + PAIRS_AT_ONCE] = most_shared(profiles[a], profiles[b]) >= bounds(n[a], n[b])[0]
        pair, count = pair[can], count[can]
        pairs.append(pair)
        counts.append(count)
        held += len(pair)
        if held >= HELD_PAIRS:
            yield flush()
            pairs, counts, held = [], [], 0
    if pairs:
        yield flush()


def _entries_of(batches, names):
    """Columns of the block's documents, then row number, key and place of each entry."""
    cols, keys, places, sizes = [[] for _ in names], [], [], []
    for b in batches:
        for c, name in zip(cols, names, strict=True):
            c.append(b.column(name).to_numpy())
        keys.append(np.frombuffer(b"".join(x.as_py() for x in b.column("keys")), np.uint64))
        places.append(np.frombuffer(b"".join(x.as_py() for x in b.column("places")), np.uint16))
        sizes.append(K.byte_lengths(b.column("keys")) // 8)
    row = np.repeat(np.arange(sum(map(len, sizes)), dtype=np.int32), np.concatenate(sizes))
    return [*(np.concatenate(c) for c in cols), row, np.concatenate(keys), np.concatenate(places)]


@K.released
def _reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The block's entries without the n-grams that only one component has."""
    doc, comp, n, last, row, keys, places = _entries_of(batches, ("doc_id", "comp", "n", "last"))
    kept = np.sort(shared_entries(comp, row, keys))
    if not len(kept):
        return
    row, keys, places = row[kept], keys[kept], places[kept]
    edges = [0, *(np.flatnonzero(np.diff(row)) + 1).tolist(), len(row)]
    for at in range(0, len(edges) - 1, 20_000):
        spans = list(zip(edges[at:at + 20_000], edges[at + 1:at + 20_001], strict=False))
        own = row[[lo for lo, _ in spans]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()] * len(spans), pa.int64()), pa.array(doc[own]), pa.array(comp[own]), pa.array(n[own]), pa.array(last[own]),
             pa.array([keys[lo:hi].tobytes() for lo, hi in spans], pa.binary()),
             pa.array([places[lo:hi].tobytes() for lo, hi in spans], pa.binary())],
            names=["block", "doc_id", "comp", "n", "last", "keys", "places"])


@K.released
def _product(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    profiles = np.frombuffer(b"".join(x.as_py() for b in batches for x in b.column("profile")), np.uint8).reshape(-1, PROFILE)
    for out in block_product(*_entries_of(batches, ("doc_id", "comp", "n", "last", "common")), profiles):
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out],
                                         names=["a", "b", "na", "nb", "shared"])


# -- exact verification -------------------------------------------------------------

@K.released
def _verify(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        known, known_set = None, None
        for lo, hi in K.text_chunks(batch, "text_b"):
            a = batch.column("a").slice(lo, hi - lo).to_numpy()
            wh, first = K.word_hashes(batch.column("text_b").slice(lo, hi - lo))
            sh, off = K.shingle_hashes(wh, first)
            for i in range(hi - lo):
                if known is None or known != a[i]:
                    w, f = K.word_hashes(batch.column("text_a").slice(lo + i, 1))
                    known, known_set = a[i], K.distinct_sorted(K.shingle_hashes(w, f)[0])
                other = K.distinct_sorted(sh[off[i]:off[i + 1]])
                both = len(np.intersect1d(known_set, other, assume_unique=True))
                keep[lo + i] = both > 0 and 100 * both >= 75 * (len(known_set) + len(other) - both)
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)],
                                         schema=schema)


def verify_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts have Jaccard >= 3/4.

    ``texts`` has one row for each id.  The texts of ``b`` travel with the pairs; a
    document that is ``a`` of many pairs is joined last, where a skewed join splits it.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    few = possible(texts.select("doc_id", "text"), ids)
    with_b = pairs.select("a", "b").join(few.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(few.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def _nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """((doc_id, text), None): what is compared.  If ids are repeated, their rows get an id of their own for each
    text (below 0, from a hash of id and text), and the second table says (doc_id, id, text_hash): the id given and the
    id that they had."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    again = texts.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    again = materialise(again, "jaccard-repeated")
    if not again.limit(1).count():
        return texts, None
    # a written table: it is broadcast if its size allows
    marked = texts.join(again.withColumn("again", F.lit(True)), "doc_id", "left")
    node = F.when(F.col("again"), -1 - F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)).otherwise(F.col("doc_id"))
    odd = marked.where("again").select(node.alias("doc_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")).distinct()
    return marked.select(node.alias("doc_id"), "text"), materialise(odd, "jaccard-odd")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text, ...).

    Null or blank text: an empty set, linked with nothing (component = own id).
    Rows with a null id come back with a null component and link nothing.  Rows
    that repeat an id are one document; if their texts differ, each text takes
    part with its own links, and all share the id's component.  Extra columns are ignored; an empty
    table gives an empty result.
    """
    texts, odd = _nodes(docs)
    if odd is None:
        return _groups(texts)
    rows = _groups(texts, odd.select("doc_id", "id")).join(odd.select("doc_id", "id"), "doc_id", "left")
    rows = materialise(rows.withColumn("own", F.coalesce("id", "doc_id")), "jaccard-rows")
    names = rows.where("n_shingles > 0").groupBy("component_id").agg(F.min("own").alias("name"))
    names = materialise(names.withColumnRenamed("component_id", "component"), "jaccard-names")
    named = rows.join(names, (F.col("component_id") == F.col("component")) & (F.col("n_shingles") > 0), "left")
    # a blank text of an id that has others is in the id's component
    shared = named.where("id is not null and name is not null").groupBy("id").agg(F.min("name").alias("shared"))
    shared = materialise(shared.withColumnRenamed("id", "of"), "jaccard-shared")
    return named.join(shared, F.col("id") == F.col("of"), "left").select(
        F.col("own").alias("doc_id"), "n_shingles", F.coalesce("shared", "name", "own").alias("component_id"))


def _groups(texts: DataFrame, same: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of (doc_id, text), where an id has one text.  ``same`` (doc_id, id): those with
    equal ``id`` are linked whatever their texts."""
    spark = texts.sparkSession
    table = materialise(texts.mapInArrow(_sets, _SETS), "jaccard-sets")
    rows = table.where("part is null").select("doc_id", "n", "fp1", "fp2", "mins", "profile")
    linked = rows.where("n > 0 and doc_id is not null")
    total = linked.agg(F.sum("n")).first()[0] or 0
    # classes of equal sets
    reps = linked.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"), F.first("mins").alias("mins"), F.first("profile").alias("profile"))
    reps = materialise(reps, "jaccard-reps")
    # star pairs on min-hashes
    keyed = reps.select("rep", "n", F.posexplode("mins").alias("perm", "key"))
    ends = keyed.groupBy("perm", "key").agg(F.min(F.struct("rep", "n")).alias("low"), F.max(F.struct("rep", "n")).alias("high"))
    centre = ends.where("low.rep < high.rep").select("perm", "key", F.explode(F.array("low", "high")).alias("c")).select(
        "perm", "key", F.col("c.rep").alias("a"), F.col("c.n").alias("na"))
    stars = (keyed.join(centre, ["perm", "key"]).where("rep <> a and 4 * least(n, na) >= 3 * greatest(n, na)")
             .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct())
    stars = materialise(stars, "jaccard-stars")
    links = materialise(verify_pairs(stars, texts).distinct(), "jaccard-links")
    if same is not None:
        own = same.join(linked.drop("mins", "profile"), "doc_id").join(reps.drop("mins", "profile"), ["fp1", "fp2", "n"]).select("id", "rep").distinct()
        low = own.groupBy("id").agg(F.min("rep").alias("b"))
        links = materialise(links.unionByName(own.join(low, "id").select(F.col("rep").alias("a"), "b")), "jaccard-linked")
    first = materialise(components(links, "jaccard-first"), "jaccard-first")
    # blocked product over the prefixes
    levels = spark.sparkContext.broadcast(shingle_levels(table))
    blocks = max(2 * spark.sparkContext.defaultParallelism, -(-(total // 4) // BLOCK_ENTRIES))
    label = reps.select("rep").distinct().join(first, F.col("rep") == F.col("id"), "left").select(
        F.col("rep").alias("doc_id"), F.coalesce("component", "rep").alias("comp"))
    prefix = texts.where("doc_id is not null").mapInArrow(_prefixes(levels), _PREFIX).where("n > 0").join(label, "doc_id")
    entries = prefix.select("doc_id", "comp", "n", "last", "prefix").mapInArrow(_to_blocks(blocks), _ENTRIES)
    entries = materialise(entries.groupBy("block").applyInArrow(_reduce, _ENTRIES), "jaccard-entries")
    common = entries.groupBy("doc_id").agg(F.sum(F.octet_length("keys") / 8).cast("long").alias("common"))
    common = common.join(reps.select(F.col("rep").alias("doc_id"), "profile"), "doc_id")
    counted = (entries.join(common, "doc_id").groupBy("block").applyInArrow(_product, _PAIRS)
               .groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared")).where(f"a <> b and shared >= {EARLY_SQL}"))
    cross = materialise(counted.select("a", "b").distinct(), "jaccard-cross")
    more = verify_pairs(cross, texts)
    # links are few beside the documents; copies hang on their representative
    all_links = first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b"))
    final = components(all_links, "jaccard-final")
    classes = reps.join(final, F.col("rep") == F.col("id"), "left").select(
        "fp1", "fp2", "n", F.coalesce("component", "rep").alias("component"))
    member = rows.select("doc_id", "n", "fp1", "fp2").join(classes, ["fp1", "fp2", "n"], "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return member.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Documents without words, and rows with a null id, are in no group and stay.  Rows with the same id and text
    stay or go together; where an id is repeated with different texts, each text is a document of its own, so that
    one which is nobody's near copy stays.
    """
    texts, odd = _nodes(docs)
    groups = _groups(texts)
    if odd is None:
        return without(docs, materialise(groups.where("component_id <> doc_id").select("doc_id").distinct(), "jaccard-gone"))
    named = groups.where("n_shingles > 0").join(odd, "doc_id", "left").select(
        "doc_id", "component_id", F.coalesce("id", "doc_id").alias("id"), "text_hash").distinct()
    named = materialise(named, "jaccard-named")
    kept = named.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first")).select(
        F.col("component_id").alias("component"), F.col("first.doc_id").alias("stays"))
    gone = named.join(materialise(kept, "jaccard-kept"), F.col("component_id") == F.col("component")).where("doc_id <> stays")
    gone = materialise(gone.select("id", "text_hash"), "jaccard-gone")
    rest = without(docs, gone.where("text_hash is null").select(F.col("id").alias("doc_id")))
    rows = rest.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    match = (F.col("row.doc_id") == F.col("id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("text_hash"))
    return rows.join(gone.where("text_hash is not null"), match, "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
