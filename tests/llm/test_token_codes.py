from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from framelake.llm import token_codes as C

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
@settings(max_examples=60, deadline=None)
def test_any_run_of_tokens(ids, data):
    codes = C.TokenCodes(C.encode_ids(np.array(ids, dtype=np.uint32)))
    assert codes.tokens(0, len(ids)).tolist() == ids
    for _ in range(5):
        start = data.draw(st.integers(0, len(ids)))
        count = data.draw(st.integers(0, len(ids) - start))
        assert codes.tokens(start, count).tolist() == ids[start : start + count]
    if ids:
        at = data.draw(st.integers(0, len(ids) - 1))
        assert codes.token(at) == ids[at]


@pytest.mark.parametrize("n", [511, 512, 513, 1024])
def test_block_borders(n):
    ids = np.where(np.arange(n) % 3, 70_000, 5).astype(np.uint32)
    codes = C.TokenCodes(C.encode_ids(ids))
    assert [codes.token(i) for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        codes.tokens(n, 1)


def test_pieces_encode_like_whole_texts():
    encoder, draw = C.WordEncoder(PATH, cache_bytes=100_000), random.Random(1)
    parts = [*"abAB'st  \t\n\x0b\x0c\r\x1c\x1f\x85 ̸́éÉİΣσς1٣中<|>", "<|endoftext|>", "<|startoftext|>", "'re", "é"]
    for _ in range(5000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows, end):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_whole_text_encoding(spark, documents, tmp_path):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["the", "Quick", "fox!", "naïve", "12", "<|endoftext|>"]) for _ in range(draw.randint(0, 40)))) for i in draw.sample(range(1000), 120)]
    rows += [(None, "no id"), (None, None), (5000, None), (5001, ""), (7, "twice b"), (7, "twice a"), (7, "twice a"), (6000, "long word " * 150_000)]
    docs = documents(rows, clashes=True).repartition(5)
    got = C.token_index(docs, PATH, 2).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows, 2)
    path = str(tmp_path / "tokens")
    C.write_tokens(docs, path, PATH, 2, segment_tokens=64)
    small = C.read_tokens(spark, path)
    assert small.count() > 20
    assert sorted(map(tuple, C.document_checks(small).collect()), key=lambda r: r[1]) == expected(rows, 2)


def test_empty_table(documents):
    assert C.token_index(documents([]), PATH, 2).collect() == []
