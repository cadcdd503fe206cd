"""Secret scan against the base rules stated character by character, and the battery on drawn strings."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest

from framelake.llm import secrets as S


def expected_base(text):
    """The base rules without regular expressions beyond one alphabet test."""
    spans = []
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    at = 0
    while at < len(text):
        hit = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if text[at : at + len(word)].translate({ord(c): c.lower() for c in string.ascii_uppercase}) == word:
                i = at + len(word)
                i += i < len(text) and text[i] in "\"'"
                while i < len(text) and text[i] == " ":
                    i += 1
                if i < len(text) and text[i] in ":=":
                    i += 1
                    while i < len(text) and text[i] == " ":
                        i += 1
                    i += i < len(text) and text[i] in "\"'"
                    end = i
                    while end < len(text) and text[end] in value:
                        end += 1
                    if end > i:
                        hit = (end, end - i)
                        break
        if hit:
            if hit[1] >= 6:
                spans.append((at, 0, hit[0]))
            at = hit[0]
        else:
            at += 1
    for kind, head, alphabet, least in ((1, "AKIA", set(string.ascii_uppercase + string.digits), 20), (2, "", set("0123456789abcdef"), 24)):
        at = 0
        while at < len(text):
            if text.startswith(head, at):
                end = at + len(head)
                while end < len(text) and text[end] in alphabet:
                    end += 1
                if end - at >= least:
                    spans.append((at, kind, end))
                at = max(end, at + 1)
            else:
                at += 1
    return sorted(spans)


def test_base_rules_on_drawn_texts():
    draw = random.Random(3)
    parts = ["password", "Secret", "TOKEN", "api_key", "apiKey", "passwd", "=", ":", " ", "  ", '"', "'", "abc", "a1b2c3", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "ſecret", "toKen", "\n", ".", "/"]
    found = 0
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert S.base_spans(text) == expected_base(text), text
        found += bool(S.base_spans(text))
    assert found > 300
    assert S.base_spans("token: token: abcdef") == []  # the failing match is consumed


def test_encodings():
    assert [S.infer_encoding(t) for t in ("0123456789", "wordsandwords", "Words", "0a1b2c", "XYZ234", "a1z9", "aB3x", "aB3+/", "aB3-_", "aB+_")] == [None, None, None, "hex", "base32", "base36", "base62", "base64", "base64url", None]


def test_battery_keeps_random_strings_and_rejects_patterns():
    rng = np.random.default_rng(5)
    for size in (16, 32, 64):
        for n in (20, 40, 100):
            p = [S.random_p(c, S.pearson(c, size), size) for c in rng.integers(0, size, (300, n))]
            assert np.mean(np.array(p) < 0.05) < 0.1
        steps = np.arange(60) % size
        assert S.random_p(steps, S.pearson(steps, size), size) < S.ALPHA  # an alphabet in order
        same = np.zeros(40, dtype=int)
        assert S.random_p(same, S.pearson(same, size), size) < S.ALPHA


def test_text_moments_match_simulation():
    rng = np.random.default_rng(6)
    q = np.array([8, 4, 2, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1.0])
    q /= q.sum()
    x2 = np.array([S.pearson(rng.choice(16, 40, p=q), 16) for _ in range(6000)])
    below = np.mean([S.text_log_p(x, 40, 16, (q**2).sum(), (q**3).sum()) > 1 for x in x2])
    assert 0.05 < below < 0.15


@pytest.fixture(scope="module")
def table(documents):
    draw = random.Random(8)
    syllables = ["th", "er", "on", "an", "re", "the", "ing", "and", "ou", "tion"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 9)))
    keys = ["".join(draw.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(5)]
    rows = [(i, " ".join(word() for _ in range(200)), "en", "s") for i in range(40)]
    rows += [(100 + i, f"{word()} {word()} {k} {word()}", "en", "s") for i, k in enumerate(keys)]
    rows += [(200, None, None, None), (201, "", "en", "s"), (None, f"x password={keys[0]}", "en", "s"), (202, "abcdefghijklmnopqrstuvwxyz0123456789" * 3, "en", "s"), (203, "long " * 200_000 + "token=abcdef", "en", "s")]
    rows += [rows[0], rows[0]]
    return keys, rows, documents(rows, clashes=True)


def test_random_keys_are_added_and_clean_text_left_alone(table):
    keys, rows, docs = table
    got = S.find_secrets(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, key in enumerate(keys):
        text = rows[40 + i][1]
        assert [(s["start"], s["kind"], s["end"]) for s in by_id[100 + i]["spans"]] == [(text.index(key), 3, text.index(key) + 40)]
    for r in got:
        text = dict((a, b) for a, b, *_ in rows)[r["doc_id"]] or ""
        assert [tuple(s) for s in r["base"]] == expected_base(text)
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
        if r["doc_id"] is not None and not 100 <= r["doc_id"] < 200:
            assert r["spans"] == r["base"]  # nothing but base spans elsewhere; a base span is not reported twice


def test_empty_table(documents):
    assert S.find_secrets(documents([])).collect() == []
