"""Elias-Fano sequences and a two-level n-gram trie on memory-mapped files."""

from __future__ import annotations

import os
import tempfile

import numpy as np

_BYTE_SELECT = np.full((256, 8), 8, np.uint8)       # position of the k-th set bit of a byte
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _BYTE_SELECT[_b, _k] = _p


SLICE = 1 << 18


class EliasFano:
    """A non-decreasing sequence of unsigned integers: packed low bits, unary high bits.

    About ``2 + log2(universe / n)`` bits an entry.  ``arrays`` may be memory-mapped;
    all queries are vectorised.
    """

    def __init__(self, n: int, low_bits: int, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.zeros = arrays["low"], arrays["high"], arrays["zeros"]

    @staticmethod
    def build(values: np.ndarray, universe: int) -> tuple[int, int, dict[str, np.ndarray]]:
        """(n, low bits, arrays) of sorted ``values`` below ``universe``."""
        n = len(values)
        low_bits = max(0, (int(universe) // max(n, 1)).bit_length() - 1)
        width, mask = np.uint64(low_bits), np.uint64((1 << low_bits) - 1)
        words = np.zeros((n * low_bits + 63) // 64 + 2, np.uint64)
        size = int(universe - 1 >> low_bits) + n + 2 if universe else n + 2
        high = np.zeros((size + 63) // 64 + 1, np.uint64)
        for k in range(0, n, SLICE):                # in slices: the working arrays stay small
            part = values[k:k + SLICE].astype(np.uint64)
            if low_bits:
                rest = part & mask
                at = np.arange(k, k + len(part), dtype=np.uint64) * width
                word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
                np.bitwise_or.at(words, word, rest << shift)
                over = shift + width > np.uint64(64)
                np.bitwise_or.at(words, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
            ones = (part >> width).astype(np.int64) + np.arange(k, k + len(part))
            np.bitwise_or.at(high, ones >> 6, np.uint64(1) << (ones & 63).astype(np.uint64))
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))]).astype(np.int64)
        return n, low_bits, {"low": words, "high": high, "zeros": zeros}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> shift
        over = shift > 0
        out[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & np.uint64((1 << self.low_bits) - 1)

    def _bit(self, p: np.ndarray) -> np.ndarray:
        return (self.high[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        """Position in the high bits where the entries with high part ``h`` begin: after the h-th zero."""
        rank = h - 1                                                # the zero's number, from 0
        word = np.searchsorted(self.zeros, rank, "right") - 1
        word = np.clip(word, 0, len(self.high) - 1)
        rest = (rank - self.zeros[word]).astype(np.int64)
        flipped = ~self.high[word]
        where = np.zeros(len(h), np.int64)
        open_ = np.ones(len(h), bool)
        for b in range(8):
            byte = (flipped >> np.uint64(8 * b) & np.uint64(255)).astype(np.int64)
            count = np.bitwise_count(byte.astype(np.uint8)).astype(np.int64)
            here = open_ & (rest < count)
            where[here] = 8 * b + _BYTE_SELECT[byte[here], rest[here]]
            open_ &= ~here
            rest = np.where(open_, rest - count, rest)
        return np.where(h > 0, (word << 6) + where + 1, 0)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The entries with numbers ``i``."""
        i = i.astype(np.int64)
        ones = (np.arange(len(self.zeros)) << 6) - self.zeros
        word = np.clip(np.searchsorted(ones, i, "right") - 1, 0, len(self.high) - 1)
        rest, bits = i - ones[word], self.high[word]
        where = np.zeros(len(i), np.int64)
        open_ = np.ones(len(i), bool)
        for b in range(8):
            byte = (bits >> np.uint64(8 * b) & np.uint64(255)).astype(np.int64)
            count = np.bitwise_count(byte.astype(np.uint8)).astype(np.int64)
            here = open_ & (rest < count)
            where[here] = 8 * b + _BYTE_SELECT[byte[here], rest[here]]
            open_ &= ~here
            rest = np.where(open_, rest - count, rest)
        high = ((word << 6) + where - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first entry >= x, whether it equals x); index n if there is none."""
        x = x.astype(np.uint64)
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        want = x & np.uint64((1 << self.low_bits) - 1)
        p = self._bucket(h)
        i = p - h
        equal = np.zeros(len(x), bool)
        live = np.flatnonzero(i < self.n)
        while len(live):
            live = live[self._bit(p[live])]                         # still in the bucket
            if not len(live):
                break
            low = self._low(i[live])
            equal[live[low == want[live]]] = True
            live = live[low < want[live]]
            p[live] += 1
            i[live] += 1
            live = live[i[live] < self.n]
        return i, equal


class MappedTrie:
    """Words, and below each word the contexts it was seen after, with quantised values.

    Level 1: the words' hashes (Elias-Fano) with their counts, and monotone pointers
    (Elias-Fano) to where each word's contexts begin in level 2.  Level 2: context
    ids, relative to their word's range: entry = begin * 2^bits + id * range length
    (Elias-Fano), one byte of value each.  Ids are spread evenly over 2^bits, so the
    entries are spread evenly too, however many contexts a word has, and a successor
    search looks at one or two of them.  Level 3, if given, is built like level 2, with
    ids of the contexts of two words; an entry of level 2 then has one more byte, its
    weight as such a context.  All arrays lie in one memory-mapped file, removed by
    :meth:`close`.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, entries: np.ndarray, values: np.ndarray, bits: int,
                 weights: np.ndarray | None = None, longer: tuple[np.ndarray, np.ndarray] | None = None):
        """``words``: sorted hashes; ``entries``: sorted word number * 2^bits + context id, fewer than
        2^(64 - bits), overwritten here; ``values`` and ``weights`` of entries; ``longer``: entries and
        values of level 3."""
        self.bits = bits
        parts = {"words": EliasFano.build(words >> np.uint64(1), 1 << 63)}
        flat = {"counts": counts.astype(np.int64), "odd": (words & np.uint64(1)).astype(np.uint8)}
        self.centres: list[np.ndarray] = []
        for level, (e, v) in enumerate([(entries, values)] + ([longer] if longer else [])):
            starts = np.searchsorted(e, np.arange(len(words) + 1, dtype=np.uint64) << np.uint64(bits))
            flat[f"codes{level}"], centres = quantise(v)
            self.centres.append(centres)
            for k in range(0, len(e), SLICE):       # in place: the caller hands its array over
                part = e[k:k + SLICE]
                word = (part >> np.uint64(bits)).astype(np.int64)
                e[k:k + SLICE] = self._relative(starts[word], starts[word + 1], part & np.uint64((1 << bits) - 1))
            parts[f"pointers{level}"] = EliasFano.build(starts.astype(np.uint64), len(e) + 1)
            parts[f"contexts{level}"] = EliasFano.build(e, max(len(e), 1) << bits)
        if weights is not None:
            flat["weights"], self.weight_centres = quantise(weights)
        for name, (_, _, arrays) in parts.items():
            flat |= {f"{name}.{k}": v for k, v in arrays.items()}
        handle, self.path = tempfile.mkstemp(suffix=".trie")
        at, places = 0, {}
        with os.fdopen(handle, "wb") as f:
            for name, a in flat.items():
                pad = -at % 8
                f.write(b"\0" * pad + a.tobytes())
                places[name] = (at + pad, a.dtype, len(a))
                at += pad + a.nbytes
        disk = np.memmap(self.path, np.uint8, "r")
        view = {n: disk[o:o + size * t.itemsize].view(t) for n, (o, t, size) in places.items()}
        self.disk = disk
        made = {name: EliasFano(n, low, {k: view[f"{name}.{k}"] for k in ("low", "high", "zeros")})
                for name, (n, low, _) in parts.items()}
        levels = range(len(self.centres))
        self.counts, self.odd, self.weights, self.words = view["counts"], view["odd"], view.get("weights"), made["words"]
        self.codes = [view[f"codes{k}"] for k in levels]
        self.pointers, self.contexts = ([made[f"{name}{k}"] for k in levels] for name in ("pointers", "contexts"))

    def _relative(self, first: np.ndarray, end: np.ndarray, context: np.ndarray) -> np.ndarray:
        return (first.astype(np.uint64) << np.uint64(self.bits)) + context * (end - first).astype(np.uint64)

    def find_words(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words, -1 where a word is not in the trie."""
        i, equal = self.words.successor(hashes >> np.uint64(1))
        out = np.full(len(hashes), -1, np.int64)
        # two words may share all bits but the last: the second of them is the next entry
        parity = (hashes & np.uint64(1)).astype(np.uint8)
        for step in (0, 1):
            at = np.minimum(i + step, max(self.words.n - 1, 0))
            if step:
                j, again = self.words.successor((hashes >> np.uint64(1)) + np.uint64(1))
                ok = equal & (out < 0) & (i + 1 < j)
            else:
                ok = equal
            ok = ok & (self.odd[at] == parity) if self.words.n else ok & False
            out[ok] = at[ok]
        return out

    def ranges(self, word: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each word's contexts, by the pointers; ``level`` 1 is that of two words."""
        pointers = self.pointers[level]
        return pointers.access(word).astype(np.int64), pointers.access(word + 1).astype(np.int64)

    def places(self, first: np.ndarray, end: np.ndarray, context: np.ndarray, level: int = 0) -> np.ndarray:
        """Number of each context id's entry in its word's range ``first``..``end``, -1 where the
        word was not seen after it: a successor search relative to the range."""
        i, equal = self.contexts[level].successor(self._relative(first, end, context))
        return np.where(equal & (i >= first) & (i < end), i, -1)

    def find(self, first: np.ndarray, end: np.ndarray, context: np.ndarray, level: int = 0) -> np.ndarray:
        """Value of each context id in its word's range, NaN where the word was not seen after it."""
        i = self.places(first, end, context, level)
        out = np.full(len(first), np.nan)
        out[i >= 0] = self.centres[level][self.codes[level][i[i >= 0]]]
        return out

    def weight(self, i: np.ndarray) -> np.ndarray:
        """Weight of entries ``i`` of level 2."""
        return self.weight_centres[self.weights[i]]

    def close(self) -> None:
        del self.disk
        os.unlink(self.path)


def quantise(values: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(byte code of each value, value of each code): equal steps, each worth the mean of its values."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(levels)
    low, high = float(values.min()), float(values.max())
    step = max((high - low) / (levels - 1), 1e-12)
    codes = np.round((values - low) / step).astype(np.uint8)
    total = np.bincount(codes, minlength=levels)
    return codes, np.bincount(codes, values, levels) / np.maximum(total, 1)
