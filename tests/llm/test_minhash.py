from __future__ import annotations

import random

import numpy as np

from framelake.llm import minhash_dedup as D


def word_pairs(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words)} if len(words) == 1 else set(zip(words, words[1:]))


def expected(rows):
    sets = [word_pairs(r[1]) for r in rows]
    label = list(range(len(rows)))
    find = lambda x: x if label[x] == x else find(label[x])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [r[0]]
        component = min(ids, default=None) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    rows, passage = [], [word() for _ in range(60)]
    for i in range(40):
        base = [word() for _ in range(draw.choice([1, 2, 5, 30, 200]))]
        if i % 3 == 0:
            base = passage + base  # a passage that many documents share
        rows.append((10 * i, " ".join(base)))
        for copy in range(draw.randint(0, 4)):
            words = list(base)
            for _ in range(draw.randint(0, max(1, len(words) // 12))):
                words[draw.randrange(len(words))] = word()
            rows.append((10 * i + copy + 1, draw.choice([" ", "\n", "  "]).join(words)))
    hot = [word() for _ in range(100)]
    for i in range(150):  # a large group of near copies
        words = list(hot)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(100)] = word()
        rows.append((1000 + i, " ".join(words).title()))
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (None, rows[0][1]), (None, "alone here"), rows[3], (rows[3][0], "other text"), (6000, "long text " * 50_000), (6001, "Long TEXT " * 60_000)]


def test_against_all_pairs(documents):
    rows = corpus()
    got = D.near_duplicates(documents(rows, clashes=True)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_signatures_estimate_similarity():
    """The share of equal values is the similarity, within four deviations."""
    draw = np.random.Generator(np.random.PCG64(2))
    common, a, b = (draw.integers(0, 1 << 64, n, dtype=np.uint64) for n in (800, 100, 100))
    values = D.signatures([np.concatenate((common, a)), np.concatenate((common, b))])
    assert values.shape[1] == 2 * D.PERMUTATIONS
    assert abs((values[0] == values[1]).mean() - 0.8) < 4 * (0.16 / (2 * D.PERMUTATIONS)) ** 0.5


def test_empty_table(documents):
    assert D.near_duplicates(documents([])).collect() == []
