"""Byte-pair encoding of many distinct words at once, with NumPy.

Gives the ids that the ``tokenizers`` library gives for a lower-casing word-end
BPE file.  Words of ASCII and of the Latin-1 letters are encoded here, all
together: every round merges the best-ranked pair of each piece.  Words with
anything else (apostrophes, other scripts, control characters) go to the library.
"""

from __future__ import annotations

import json
import os

import numpy as np

from . import kernel as K

_NONE = np.iinfo(np.int32).max
_SPACE, _LETTER, _DIGIT, _OTHER, _FOREIGN, _LEAD = range(6)


def _classes() -> np.ndarray:
    c = np.full(256, _FOREIGN, np.uint8)
    c[33:127] = _OTHER
    c[ord("a"):ord("z") + 1] = c[ord("A"):ord("Z") + 1] = _LETTER
    c[ord("0"):ord("9") + 1] = _DIGIT
    c[ord("'")] = _FOREIGN
    c[32] = _SPACE
    c[0xC3] = _LEAD
    return c


_CLASS = _classes()


def _byte_names() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in names:
            names[b], spare = chr(spare), spare + 1
    return [names[b] for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        names = _byte_names()
        self.inner = np.array([vocab[n] for n in names], np.int32)
        self.final = np.array([vocab[n + suffix] for n in names], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._table(left << 32 | right)

    def _table(self, keys: np.ndarray) -> None:
        """Open-addressing table from a pair of ids to its rank."""
        self.bits = max(12, int(4 * len(keys) - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        rank, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(rank):
            free = self.keys[slot] == -1
            s, first = np.unique(slot[free], return_index=True)
            took = np.flatnonzero(free)[first]
            self.keys[s], self.ranks[s] = keys[rank[took]], rank[took]
            left = np.ones(len(rank), bool)
            left[took] = False
            rank, slot = rank[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 32 | b
        slot = self._slot(keys)
        out, open_ = np.full(len(keys), _NONE, np.int32), np.arange(len(keys))
        while len(open_):
            there = self.keys[slot]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            go = ~hit & (there != -1)
            open_, slot = open_[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def merge(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of pieces given as their byte symbols; no piece is empty."""
        piece = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.cumsum(sizes) - sizes
        names = np.arange(len(sizes))
        rank = np.full(len(sym), _NONE, np.int32)
        inside = np.flatnonzero(piece[:-1] == piece[1:])
        rank[inside] = self.rank(sym[inside], sym[inside + 1])
        done_ids, done_names, done_sizes = [], [], []
        while len(sym):
            low = np.minimum.reduceat(rank, starts)
            over = low == _NONE
            if over.any():
                width = np.diff(np.append(starts, len(sym)))
                gone = np.repeat(over, width)
                done_ids.append(sym[gone])
                done_names.append(names[over])
                done_sizes.append(width[over])
                sym, rank = sym[~gone], rank[~gone]
                names, low, width = names[~over], low[~over], width[~over]
                starts = np.cumsum(width) - width
                if not len(sym):
                    break
                piece = np.repeat(np.arange(len(width)), width)
            at = np.flatnonzero(rank == low[piece])
            at = at[np.concatenate([[True], piece[at[1:]] != piece[at[:-1]]])]      # the first of each piece
            sym[at] = self.merged[low]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, rank, piece = sym[stay], rank[stay], piece[stay]
            shift = np.arange(len(at))
            at, starts = at - shift, starts - shift
            rank[at] = _NONE
            ahead = at[(at + 1 < len(sym)) & (piece[np.minimum(at + 1, len(sym) - 1)] == piece[at])]
            rank[ahead] = self.rank(sym[ahead], sym[ahead + 1])
            behind = at[(at > 0) & (piece[at - 1] == piece[at])] - 1
            rank[behind] = self.rank(sym[behind], sym[behind + 1])
        out_sizes = np.zeros(len(sizes), np.int64)
        if not done_ids:
            return np.zeros(0, np.int32), out_sizes
        which, width = np.concatenate(done_names), np.concatenate(done_sizes)
        out_sizes[which] = width
        out_at = np.cumsum(out_sizes) - out_sizes
        ids = np.empty(out_sizes.sum(), np.int32)
        flat = np.concatenate(done_ids)
        ids[np.repeat(out_at[which] - (np.cumsum(width) - width), width) + np.arange(len(flat))] = flat
        return ids, out_sizes

    def encode(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the words, ids per word) of words given as byte spans of a UTF-8 buffer."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        length = ends - starts
        # the words, each followed by a space
        stop = np.cumsum(length + 1) - 1
        here = stop - length
        raw = np.full(stop[-1] + 1, 32, np.uint8)
        spread = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        raw[np.repeat(here, length) + spread] = text[np.repeat(starts, length) + spread]
        kind = _CLASS[raw]
        lead = kind == _LEAD
        tail = np.concatenate([[False], lead[:-1]])
        letter = tail & (raw >= 0x80) & (raw <= 0xBF) & (raw != 0x97) & (raw != 0xB7)
        kind[letter] = _LETTER
        kind[lead] = np.where(np.concatenate([letter[1:], [False]])[lead], _LETTER, _FOREIGN)
        kind[:-1][(raw[:-1] == ord("<")) & (raw[1:] == ord("|"))] = _FOREIGN       # may begin a special token
        foreign = np.concatenate([[0], np.cumsum(kind == _FOREIGN)])
        slow = np.flatnonzero(foreign[stop] > foreign[here])
        coded = [e.ids for e in self.library.encode_batch_fast(
            [raw[here[i]:stop[i]].tobytes().decode() for i in slow], add_special_tokens=False)]
        raw[(raw >= 65) & (raw <= 90)] += 32
        raw[letter & (raw <= 0x9E)] += 32
        is_slow = np.zeros(len(starts), bool)
        is_slow[slow] = True
        kind[np.repeat(is_slow, length + 1)] = _SPACE
        before = np.concatenate([[_SPACE], kind[:-1]])
        after = np.concatenate([kind[1:], [_SPACE]])
        solid = kind != _SPACE
        begin = np.flatnonzero(solid & ((before != kind) | (kind == _DIGIT)))
        end = np.flatnonzero(solid & ((after != kind) | (kind == _DIGIT))) + 1
        _, first, inverse = np.unique(K.hash_spans(raw, begin, end), return_index=True, return_inverse=True)
        size = (end - begin)[first]
        place = np.repeat(begin[first] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        sym = self.inner[raw[place]]
        if len(size):
            last = np.cumsum(size) - 1
            sym[last] = self.final[raw[place[last]]]
        ids, n = self.merge(sym, size)
        flat, width = take(ids, np.cumsum(n) - n, n, inverse)
        owner = np.searchsorted(here, begin, "right") - 1
        per_word = np.bincount(owner, width, len(starts)).astype(np.int64)
        if not len(slow):
            return flat, per_word
        per_word[slow] = [len(c) for c in coded]
        out = np.empty(per_word.sum(), np.int32)
        mine = np.repeat(~is_slow, per_word)
        out[mine] = flat
        out[~mine] = np.fromiter((i for c in coded for i in c), np.int32, int(per_word[slow].sum()))
        return out, per_word


def take(ids: np.ndarray, start: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id runs of ``rows`` one after the other, and their lengths."""
    width = size[rows]
    return ids[np.repeat(start[rows] - (np.cumsum(width) - width), width) + np.arange(width.sum())], width
