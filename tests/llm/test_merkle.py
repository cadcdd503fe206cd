from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from framelake.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    for level in levels[:-1]:
        first = at - at % 8
        run = level[first : first + 8]
        yield at - first, run[: at - first] + run[at - first + 1 :]
        at //= 8


def expected(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault("" if row[2] is None else "=" + row[2], []).append((row[0] is not None, row[0] or 0, leaf(row)))
    trees = {k: tree([x[2] for x in sorted(v)]) for k, v in by_lang.items()}
    langs = sorted(trees, key=str.encode)
    top = tree([trees[k][-1][0] for k in langs])
    out = []
    for at, k in enumerate(langs):
        for i, (_, doc_id, own) in enumerate(sorted(by_lang[k])):
            steps = [*path(trees[k], i), *path(top, at)]
            out.append((own, trees[k][-1][0], top[-1][0], h(*(s for _, run in steps for s in run))))
    return sorted(out)


@pytest.mark.parametrize("sizes", [(1,), (8, 9), (1, 64, 65, 200)])
def test_against_plain_trees(documents, sizes):
    langs = ["en", None, "é", "de"]
    rows = [(100 * k + i, f"Text {i} É", langs[k], "s") for k, n in enumerate(sizes) for i in range(n)]
    rows += [(None, None, "en", None), (3, "", "en", "s"), rows[0], rows[0]]
    docs = documents(rows, clashes=True)
    full = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = M.proof_digest(M.manifest(docs)).collect()
    as_hex = sorted((r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), r["proof"]) for r in got)
    assert as_hex == expected(full)
    assert all(r["folded"] == r["root"] for r in got)


def test_a_changed_row_does_not_verify(documents):
    rows = [(i, f"text {i}", "en", "s") for i in range(100)]
    shown = F.when(F.col("doc_id") % 3 == 0, M.leaf_digest(F.lit("other")))
    got = M.manifest(documents(rows), shown).collect()
    assert {r["doc_id"] for r in got if r["folded"] != r["root"]} == set(range(0, 100, 3))


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 700])
def test_positions_follow_from_sizes(leaves):
    """A log of names instead of digests: where each node is, is known beforehand."""
    levels = M.height(leaves)
    digests = [i.to_bytes(32, "big") for i in range(leaves)]
    log = M.append_nodes(digests, levels)
    nodes, at = [log[i : i + 32] for i in range(0, len(log), 32)], digests
    for level in range(levels + 1):
        assert [nodes[M.position(level, i, leaves, levels)] for i in range(len(at))] == at
        at = [M.node_digest(at[i : i + 8]) for i in range(0, len(at), 8)]


def test_trees_of_more_than_a_block(spark):
    """Two rounds: the proofs of some leaves lead to the root of all."""
    n = M.BLOCK + 70
    digests = spark.range(n).select(F.lit("t").alias("tree"), F.col("id").alias("at"), F.lit(n).cast("long").alias("size"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    rounds = M.append_log(digests, "test-merkle")
    assert len(rounds) == 2
    want = tree([hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)])
    (root,) = M.roots(rounds).collect()
    assert root["root"].hex() == want[-1][0]
    above = {r["block"]: r["proof"] for r in M.leaf_proofs(rounds, spark.sql("SELECT 't' AS tree, X'' AS proof")).collect()}
    for block in rounds[0].collect():
        steps = M.block_steps(block["log"], block["leaves"], block["size"])
        for at in (0, block["leaves"] - 1):
            own = hashlib.sha256(str(block["block"] * M.BLOCK + at).encode()).digest()
            proof = M._leaf_proof(steps, at, above[block["block"]])
            assert M.fold(own, proof) == root["root"]
            assert M.siblings(proof).hex() == "".join(s for _, run in path(want, block["block"] * M.BLOCK + at) for s in run)


def test_empty_table(documents):
    assert M.manifest(documents([])).collect() == []

