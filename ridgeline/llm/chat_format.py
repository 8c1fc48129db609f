"""Chat formatting by token-level assembly.

Each turn's role and text are encoded on their own, so no token spans a marker;
the markers are reserved ids spliced in between and cannot come out of the
encoder.  The loss mask is a prefix sum of +1 where a trained text begins and -1
where it ends.  Control strings that occur in a text are escaped first, so the
rendered string is as unambiguous as the ids; reading back undoes the escapes.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_FILE = "byte_bpe_50k.json"
VOCABULARY = 50257
#: Reserved ids, in order from VOCABULARY: how they are rendered.
MARKS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<|reply|>", "</s>", "<|role|>", "<|text|>")
SYS, SYS_END, INST, INST_END, REPLY, END, ROLE, TEXT = range(VOCABULARY, VOCABULARY + len(MARKS))
#: Strings that must not stand in a text as they are.
CONTROL = MARKS + ("<s>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
ESCAPE = "␛"
_CODES = {ESCAPE: "0"} | {s: chr(ord("A") + k) for k, s in enumerate(CONTROL)}
_STRINGS = {code: s for s, code in _CODES.items()}
_FIND = re.compile("|".join(re.escape(s) for s in sorted(_CODES, key=len, reverse=True)))
_BACK = re.compile(ESCAPE + "(.)")
FRAME = {"system": (SYS, SYS_END), "user": (INST, INST_END), "assistant": (REPLY, END)}
_OPENED = {frame[0]: role for role, frame in FRAME.items()}
TRAINED = "assistant"


def escape(text: str) -> str:
    """Each control string, and the escape character itself, becomes the escape
    character and one code letter."""
    return _FIND.sub(lambda m: ESCAPE + _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: _STRINGS[m[1]], text)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


_LOADED: dict = {}


def _tokenizer(path: str | None):
    """The tokenizer, loaded once in a Python worker (``path`` None: the installed file)."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path or tokenizer_path())
        t.encode_special_tokens = True
        _LOADED[path] = t
    return _LOADED[path]


def assemble(roles: list[str], texts: list[str], encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, loss mask) of turns; ``encode``: strings to lists of ids."""
    framed = [r in FRAME for r in roles]
    role_ids = iter(encode([escape(r) for r, known in zip(roles, framed, strict=True) if not known]))
    pieces, sizes, deltas, at = [], [], [], 0
    for role, known, body in zip(roles, framed, encode([escape(t) for t in texts]), strict=True):
        head = [FRAME[role][0]] if known else [ROLE, *next(role_ids), TEXT]
        tail = [FRAME[role][1] if known else END]
        pieces += [head, body, tail]
        if role == TRAINED and body:
            deltas.append((at + len(head), 1))
            deltas.append((at + len(head) + len(body), -1))
        sizes.append(len(head) + len(body) + len(tail))
        at += sizes[-1]
    ids = np.fromiter((x for p in pieces for x in p), np.int32, at)
    delta = np.zeros(at + 1, np.int8)
    for place, change in deltas:
        delta[place] += change
    return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), np.cumsum(delta[:-1]) > 0


def render(ids, decode) -> str:
    """The formatted string of one turn's ids."""
    out, run = [], []
    for x in list(ids) + [VOCABULARY]:
        if x >= VOCABULARY:
            out.append(decode(run))
            run = []
            out.append(MARKS[x - VOCABULARY])
        else:
            run.append(x)
    return "".join(out[:-1])


def read_turn(ids, mask, decode) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, code points of the rendered turn) of one turn's ids."""
    ids = np.asarray(ids)
    if ids[0] == ROLE:
        at = int(np.flatnonzero(ids == TEXT)[0])
        role = unescape(decode(ids[1:at].tolist()))
        body = ids[at + 1:-1]
    else:
        role, body = _OPENED[int(ids[0])], ids[1:-1]
    return role, unescape(decode(body.tolist())), unescape(decode(ids[np.asarray(mask)].tolist())), len(render(ids, decode))


_TURNS = "conv_id long, turn long, ids array<int>, loss_mask array<boolean>"


def _encode(path):
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("loss_mask", pa.list_(pa.bool_()))])

    def run(batches):
        t = _tokenizer(path)
        encode = lambda xs: [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, off, mask = assemble(part.column("role").to_pylist(), part.column("text").to_pylist(), encode)
                yield pa.RecordBatch.from_arrays([
                    part.column("conv_id"), part.column("turn"),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(ids)),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(mask))], schema=schema)
    return run


def format_turns(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """(conv_id, turn, ids, loss_mask) for each row of ``conversations`` (conv_id, turn, role, text, ...).

    A conversation's token sequence is its rows' ids in the order of ``turn``.  Null
    role or text: empty.  Roles other than system, user and assistant are written
    out.  Null or repeated ids and turns are kept; other columns are ignored.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_encode(path), _TURNS)


def _read_back(path):
    fields = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def run(batches):
        t = _tokenizer(path)
        decode = lambda ids: t.decode(ids, skip_special_tokens=False) if ids else ""
        state, done = None, []

        def close():
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flush():
            cols = list(zip(*done, strict=True)) or [[]] * len(fields)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)],
                                             schema=pa.schema(fields))
            done.clear()
            return out

        for batch in batches:
            for conv, ids, mask in zip(batch.column("conv_id"), batch.column("ids"), batch.column("loss_mask"), strict=True):
                conv = conv.as_py()
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, trained, size = read_turn(ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False), decode)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(trained)
                state[4].update(trained.encode())
                state[5] += size
            yield flush()
        if state is not None:
            close()
        yield flush()
    return run


def read_conversations(turns: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each conversation, decoded from the ids and masks of :func:`format_turns`.

    Rows are brought together by ``conv_id`` and streamed in the order of ``turn``
    (ties: by their ids); a conversation of any length needs a constant amount of memory.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(_read_back(path), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                                "loss_sha256 string, formatted_chars long")
