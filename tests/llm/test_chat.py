from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from framelake.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, piece string, ids string, loss string"
PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "/", "<|turn|>", "<|says|>", "<|done|>", "<|endoftext|>", "ok", " ", "\n", "é", "中", "\u0000", "🎉", "<<SYS>>"]


@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=30))
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


@given(st.lists(st.tuples(st.integers(0, 6), st.booleans()), max_size=30))
def test_mask_by_prefix_sums(segments):
    lengths = np.array([n for n, _ in segments], dtype=np.int64)
    flags = np.array([f for _, f in segments], dtype=bool)
    assert chat.loss_mask(lengths, flags).tolist() == [int(f) for n, f in segments for _ in range(n)]


def expected(rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    key = lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")
    convs: dict = {}
    for conv, _, role, text in sorted(rows, key=key):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(sum(map(len, chat.MARKS)) + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns)
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), chars)
    return out


def conversations():
    draw = random.Random(4)
    text = lambda: "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 15)))
    rows = [(c, t, draw.choice(["user", "assistant", "system", "assistant"]), text()) for c in range(30) for t in range(draw.randint(1, 9))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, None, None), (50, 1, "assistant", None), (51, 1, "assistant", "x"), (51, 1, "assistant", "x"), (51, 1, "[INST]", "")]
    rows += [(52, t, "assistant" if t % 2 else "user", "word " * 50) for t in range(300)]  # one long conversation
    rows += [(53, 0, "assistant", "very long " * 100_000)]
    return rows


def test_read_back(spark):
    rows = conversations()
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    want = expected(rows)
    for piece_tokens in (chat.PIECE_TOKENS, 64):
        formatted = chat.format_conversations(table, PATH, piece_tokens=piece_tokens).cache()
        assert max(len(r["ids"]) for r in formatted.select("ids").collect()) <= piece_tokens + 0
        got = {r[0]: tuple(r[1:]) for r in chat.read_back(formatted, PATH).collect()}
        assert got == want


def test_no_text_makes_a_reserved_id(spark):
    codec = chat.codec(PATH)
    for text in PARTS + ["<|endoftext|>" * 3]:
        assert max([i for ids in codec.encode([text]) for i in ids], default=0) < codec.reserved


def test_empty_table(spark):
    assert chat.formatted_digests(spark.createDataFrame([], SCHEMA), PATH).collect() == []
