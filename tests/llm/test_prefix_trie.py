from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from framelake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth long, at string"


def expected(rows):
    """All nodes, by sequences themselves."""
    own: dict = {}
    for conv_id, turn, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(conv_id, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        base = [] if c is None else own.get(c - c % 5, [])
        rebuilt[c] = tuple(base[:h] + turns[h:])
    order = lambda c: (c is None, c or 0)
    members: dict = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        ends = sorted((c for c in ids if len(rebuilt[c]) == len(node)), key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        leaves = [n for n in below if not any(m[:-1] == n for m in below if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        parent = min(members[node[:-1]], key=order) if node else None
        out.append((min(ids, key=order), len(node), parent, len(ids), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


def conversations():
    draw = random.Random(5)
    rows = []
    for c in [*range(60), 1000, -7]:
        turns = draw.choice([1, 2, 3, 8, 12]) if c != 30 else 40
        shared = draw.random() < 0.5
        for t in range(turns):
            text = draw.choice(["a", "é", ""]) if shared else f"{c} {t}"
            rows.append((c, t if t else draw.choice([0, None]), draw.choice(["user", None]) if t == 2 else "user", draw.choice([text, text, None]) if t == 3 else text))
    rows += [(None, 0, "user", "x"), (None, 1, None, None), (31, 500, "user", "again"), (31, 500, "user", "again")]
    return [(*r, 1, "x") for r in rows]


@pytest.mark.parametrize("segment, shard", [(P.SEGMENT, P.SHARD), (3, 20), (1, 7)])
def test_against_sequences(spark, segment, shard):
    """As it is, and with segments and shards so small that all is cut."""
    rows = conversations()
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), segment, shard).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_empty_table(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_slots_are_minimal_perfect_and_verified():
    draw = np.random.Generator(np.random.PCG64(1))
    for n in (0, 1, 2, 1000, 50_000):
        hi, lo = (draw.integers(0, 1 << 64, n, dtype=np.uint64) for _ in range(2))
        table = P.SlotTable(hi, lo)
        assert sorted(table.slots(hi, lo).tolist()) == list(range(n))
        assert (table.slots(hi ^ np.uint64(1), lo) == -1).all()


def test_accumulate_goes_up_all_levels():
    parent, depth = np.array([-1, 0, 1, 1, 0, 2]), np.array([0, 1, 2, 2, 1, 3])
    assert P.accumulate(parent, depth, np.array([0, 0, 0, 1, 1, 1])).tolist() == [3, 2, 1, 1, 1, 1]
