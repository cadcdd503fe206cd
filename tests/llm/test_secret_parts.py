"""Keys in runs that fit no encoding as a whole."""

from __future__ import annotations

import random
import string

from framelake.llm import secrets as S


def _rows():
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("eeeeeettttaaoinshr") for _ in range(draw.randint(2, 30)))
    drawn = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    base62 = string.ascii_letters + string.digits
    keys = [("api/v1/my-service/", drawn(base62, 40)), ("hooks/T00_x/", drawn(base62, 40)), ("my-bucket/", drawn(base62 + "+/", 20) + "+" + drawn(base62 + "+/", 43))]
    rows = [(i, " ".join(word() for _ in range(100))) for i in range(30)]
    return keys, rows + [(100 + i, f"{word()} {path}{key} {word()}") for i, (path, key) in enumerate(keys)]


def test_keys_in_paths(documents):
    keys, rows = _rows()
    got = {r["doc_id"]: r["spans"] for r in S.find_secrets(documents(rows)).collect()}
    texts = dict(rows)
    for i, (_, key) in enumerate(keys):
        start = texts[100 + i].index(key)
        assert any(s["start"] <= start and s["end"] >= start + len(key) for s in got[100 + i]), key
        assert len(got[100 + i]) == 1
    assert all(not got[i] for i in range(30))


def test_parts_of_a_run():
    key = "a1B2" * 10
    assert S.key_parts(key) == [(0, 40)]
    run = f"a/b-c/{key}"
    assert (run.index(key), len(run)) in S.key_parts(run)


def test_overlapping_parts_are_reported_once():
    found = [{"start": s, "end": e} for s, e in ((0, 30), (25, 60), (55, 90))]
    tests = [{"class": 1, "bin": b, "random_p": 0.5} for b in (5, 6, 7)]
    spans = [(s["start"], s["end"]) for s in S.added_spans([], found, tests, {1: 1})]
    assert sorted(spans) == [(0, 30), (55, 90)]
