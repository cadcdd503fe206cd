from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from framelake.llm import simhash_dedup as H
from framelake.llm.components import connected_components


def fingerprint(text, size=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, radius=3):
    """Component of each row: the least doc_id within reach, by all pairs."""
    prints = [fingerprint(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for k, (doc_id, *_) in zip(label, rows, strict=True):
        least[k] = min((x for x in (least.get(k), doc_id) if x is not None), default=None)
    return [(i, p, least[k]) for (i, *_), p, k in zip(rows, prints, label, strict=True)]


def test_fingerprints_one_by_one():
    draw = random.Random(1)
    texts = [" ".join(draw.choice(["a", "B", "é", "\x1c", "zz"]) for _ in range(draw.randint(0, 8))) for _ in range(150)]
    texts += ["", " \t\x0b", "same words here " * 400, "x " * 254, "x y " * 128, "x y z " * 900]
    got = H.fingerprints([t.encode() for t in texts])
    assert got.tolist() == [fingerprint(t) for t in texts]
    assert H.fingerprints([]).tolist() == [] and H.fingerprints([b"", b" "]).tolist() == [0, 0]


@pytest.mark.parametrize("tile", [8, 1024])
def test_links_between_tiles(spark, tile):
    draw = random.Random(2)
    prints = {0, (1 << 64) - 1, 1, 7, 15}
    for _ in range(40):
        centre = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):  # groups whose members lie within a few bits
            x = centre
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    edges = H.link_edges(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), tile=tile)
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    rows = [(i, None) for i in range(len(prints))]
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(label)
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    groups = lambda labels: sorted(sorted(i for i in range(len(prints)) if labels[i] == k) for k in set(labels))
    assert groups([found.get(s, s) for s in signed]) == groups(label)


def test_forest_of_a_dense_tile():
    rng = np.random.default_rng(3)
    a = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)))
    x, y = H.linked(a, a, True)
    assert len(x) < len(a) and len(set(y.tolist())) == 1


def test_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(90)] + [(7, 7), (-5, 600)]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == label and len(got) == len(label)


def near_rows():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 6)))
    rows = []
    for g in range(25):
        base = [word() for _ in range(draw.randint(1, 150))]
        for _ in range(draw.randint(1, 5)):
            copy = list(base)
            if draw.random() < 0.6:
                copy[draw.randrange(len(copy))] = word()
            rows.append((draw.randint(0, 10_000), " ".join(copy)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (None, rows[0][1]), (None, "only null ids here"), (None, "only null ids here"), (5, "very long " * 200_000), rows[3], rows[3], (rows[4][0], "other text, same id")]
    return rows


def test_near_duplicates_and_keepers(documents):
    rows = near_rows()
    docs = documents(rows, clashes=True)
    got = [(r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in H.near_duplicates(docs, tile=16).collect()]
    want = expected(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = H.deduplicate(docs)
    assert kept.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # One per component: one for each name, a second one where the id of a row
    # with another text names two, and the one whose rows all lack an id.
    assert len(kept) == len({c for _, _, c in want if c is not None}) + 2
    components = {(i, fingerprint(t)): c for i, p, c in want for (j, t, *_) in rows if j == i and fingerprint(t) == p}
    assert all(components[i, fingerprint(t)] == i for i, t in kept)


def test_empty_table(documents):
    assert H.near_duplicates(documents([])).collect() == []
    assert H.deduplicate(documents([])).collect() == []
