import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm import chat_format as C

PIECES = st.lists(st.sampled_from([*C.CONTROL, C.ESCAPE, "0", "A", "<", "/s>", "[INST", "]", "é", "😀", " ", "\n", "\x00", "a\u0308", "ok"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_escape_round_trip(pieces):
    text = "".join(pieces)
    out = C.escape(text)
    assert C.unescape(out) == text and not any(s in out for s in C.CONTROL)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "</s>"]), PIECES), min_size=1, max_size=6))
def test_assembly_round_trip(turns):
    t = C._tokenizer(None)
    encode = lambda xs: [e.ids for e in t.encode_batch(xs, add_special_tokens=False)]
    decode = lambda ids: t.decode(ids, skip_special_tokens=False) if ids else ""
    roles, texts = [r for r, _ in turns], ["".join(p) for _, p in turns]
    ids, off, mask = C.assemble(roles, texts, encode)
    for k, (role, text) in enumerate(zip(roles, texts)):
        own = ids[off[k]:off[k + 1]]
        got = C.read_turn(own, mask[off[k]:off[k + 1]], decode)
        assert got[:3] == (role, text, text if role == "assistant" else "")
        assert got[3] == len(C.render(own, decode))
        inner = C.render(own, decode)[len(C.MARKS[own[0] - C.VOCABULARY]):-len(C.MARKS[own[-1] - C.VOCABULARY])]
        assert not any(s in inner.replace("<|text|>", "", 1 if role not in C.FRAME else 0) for s in C.CONTROL)


def digest(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda x: x[0])
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(spark, rows, extra=False):
    d = spark.createDataFrame([r + (7, "x") for r in rows] if extra else rows,
                              "conv_id long, turn long, role string, text string" + (", ids long, loss_mask string" if extra else ""))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_conversations(C.format_turns(d)).collect()}


def test_conversations(spark):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "assistant", "tool"]),
             "".join(rnd.choice([*C.CONTROL, "word ", "é", "\n", C.ESCAPE]) for _ in range(rnd.randint(0, 20)))) for c in range(60) for t in range(rnd.randint(1, 8))]
    rnd.shuffle(rows)
    assert got(spark, rows) == digest(rows)
    assert got(spark, rows, extra=True) == digest(rows)


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "x"), (None, 0, "user", "n"), (3, None, "assistant", "first"),
            (3, 0, "assistant", "second"), (4, 0, "assistant", "long " * 40000), (5, 0, "user", "same"), (5, 0, "user", "same")]
    assert got(spark, rows) == digest(rows)
    assert got(spark, []) == {}
    one = [(9, t, "assistant", f"turn {t}</s>") for t in range(1500)]        # a conversation of many batches
    assert got(spark, one) == digest(one)


def test_reserved_ids_are_outside_the_vocabulary():
    t = C._tokenizer(None)
    assert t.get_vocab_size() <= C.VOCABULARY and len(set(C.MARKS)) == C.TEXT - C.SYS + 1
    assert np.unique(list(C._STRINGS)).size == len(C._CODES)
