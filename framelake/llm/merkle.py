"""Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf; the leaves of a tree come in order and every eight
consecutive nodes of a level become one of the next, until one is left. A tree
is built in rounds. In a round, builders take aligned runs of ``BLOCK`` nodes
and append every node to their log when it completes: a leaf when it comes, an
inner node right after the last node below it. A log is thus the postorder of
its subtree and ends with the subtree's root, and the roots of a round are the
leaves of the next.

Where a node is in the log follows from the sizes of the subtrees before it
(``position``), so a proof is read out of the logs by addresses alone: the
siblings of a leaf within its block, then those of the block's root in the next
round's log, up to the root. No builder holds more than a block, however large
a tree is, and a tree of n leaves takes log(n) / log(BLOCK) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import python_ready, written
from framelake.llm.ranks import with_places

ARITY = 8
LEVELS = 4  # of a builder
BLOCK = ARITY**LEVELS
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (binary) of the values, each ``-`` if null, else its UTF-8 byte
    count, a colon and itself."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_digest(children: list[bytes]) -> bytes:
    """Digest of a node: SHA-256 of its children's digests as lower-case hex."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while ARITY**levels < leaves:
        levels += 1
    return levels


def position(level: int, index: np.ndarray | int, leaves: int, levels: int) -> np.ndarray | int:
    """Place in the postorder of a tree of ``leaves`` leaves and ``levels``
    levels above them: the nodes that complete before the ``index``-th of
    ``level`` does. With ``end`` leaves appended, this level and those below
    have completed all nodes that start before ``end``, those above only such
    as end before it."""
    end = np.minimum((np.asarray(index) + 1) * ARITY**level, leaves)
    done = sum(-(-end // ARITY**j) for j in range(level + 1)) + sum((end - 1) // ARITY**j for j in range(level + 1, levels + 1))
    return done - 1


def append_nodes(leaves: list[bytes], levels: int) -> bytes:
    """The log of one builder: ``leaves`` and what they complete, in order."""
    log, open_nodes = [], [[] for _ in range(levels + 1)]

    def append(level: int, digest: bytes) -> None:
        log.append(digest)
        open_nodes[level].append(digest)
        if len(open_nodes[level]) == ARITY and level < levels:
            close(level)

    def close(level: int) -> None:
        run, open_nodes[level] = open_nodes[level], []
        append(level + 1, node_digest(run))

    for leaf in leaves:
        append(0, leaf)
    for level in range(levels):
        if open_nodes[level]:
            close(level)
    return b"".join(log)


def append_log(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The rounds of the trees whose leaves are ``tree, at, size, digest``:
    per round a table ``tree, block, size, leaves, log`` (``size`` leaves of
    the tree in this round, ``leaves`` of the block). Only the largest size of
    a round comes to the driver."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        size = table["size"][0].as_py()
        log = append_nodes(table["digest"].to_pylist(), min(LEVELS, height(size)))
        return pa.table({"tree": table["tree"][:1], "block": table["block"][:1], "size": [size], "leaves": [table.num_rows], "log": pa.array([log], pa.binary())})

    rounds = []
    while True:
        blocks = python_ready(leaves).withColumn("block", F.floor(F.col("at") / BLOCK)).groupBy("tree", "block")
        log = written(blocks.applyInArrow(build, "tree string, block long, size long, leaves long, log binary"), f"{name}-{len(rounds)}")
        rounds.append(log)
        if (log.agg(F.max("size")).first()[0] or 0) <= BLOCK:
            return rounds
        above = F.ceil(F.col("size") / BLOCK)
        leaves = log.select("tree", F.col("block").alias("at"), above.alias("size"), _root(F.col("log")).alias("digest"))


def _root(log: Column) -> Column:
    return F.substring(log, -DIGEST, DIGEST)


def roots(rounds: list[DataFrame]) -> DataFrame:
    """``tree, root`` of each tree."""
    return rounds[-1].select("tree", _root(F.col("log")).alias("root"))


def block_steps(log: bytes, leaves: int, size: int) -> list[list[bytes]]:
    """Per level of a block, the proof step of each node: its place in the run,
    the number of siblings, their digests, all read from the log by address."""
    levels = min(LEVELS, height(size))
    nodes = np.frombuffer(log, dtype=np.uint8).reshape(-1, DIGEST)
    steps = []
    for level in range(levels):
        count = -(-leaves // ARITY**level)
        digests = [d.tobytes() for d in nodes[position(level, np.arange(count), leaves, levels)]]
        own = []
        for at in range(count):
            first = at - at % ARITY
            run = digests[first : first + ARITY]
            del run[at - first]
            own.append(bytes((at - first, len(run))) + b"".join(run))
        steps.append(own)
    return steps


def _leaf_proof(steps: list[list[bytes]], at: int, above: bytes) -> bytes:
    return b"".join([own[at // ARITY**level] for level, own in enumerate(steps)]) + above


def leaf_proofs(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``tree, block, proof`` for the blocks of the lowest round: the proof of
    the block's root. ``above`` has ``tree, proof``, the proof of a tree's root."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, size, leaves, log, over in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps = block_steps(log, leaves, size)
                proofs = pa.array([_leaf_proof(steps, at, over) for at in range(leaves)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([tree] * leaves), pa.array(block * BLOCK + np.arange(leaves)), proofs], ["tree", "block", "proof"])

    known = above.select("tree", F.lit(0).cast("long").alias("block"), "proof")
    for log in reversed(rounds[1:]):
        with_proof = log.join(known, ["tree", "block"]).select("tree", "block", "size", "leaves", "log", "proof")
        known = with_proof.mapInArrow(extract, "tree string, block long, proof binary")
    return known


def fold(digest: bytes, proof: bytes) -> bytes:
    """The root that ``proof`` gives for the leaf ``digest``."""
    at = 0
    while at < len(proof):
        place, count = proof[at], proof[at + 1]
        at += 2
        run = [proof[at + DIGEST * i : at + DIGEST * (i + 1)] for i in range(count)]
        at += DIGEST * count
        digest = node_digest([*run[:place], digest, *run[place:]])
    return digest


def siblings(proof: bytes) -> bytes:
    """The digests of a proof without its places and counts."""
    out, at = [], 0
    while at < len(proof):
        end = at + 2 + DIGEST * proof[at + 1]
        out.append(proof[at + 2 : end])
        at = end
    return b"".join(out)


def _tree_key(lang: Column) -> Column:
    """Never null; nulls first, otherwise in bytewise order."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def manifest(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded`` for each row of ``docs``
    (columns ``FIELDS``; others are read only by ``shown``).

    A row's leaf is the digest of its fields. The leaves of a language, in
    ascending ``doc_id`` (nulls first, equal ids by digest), are a tree with
    root ``subroot``; the subroots, null language first, then bytewise, are the
    tree of ``root``. ``proof`` leads from the leaf to ``root``; ``folded`` is
    the root that it gives for ``shown``, a digest of the row as someone claims
    it to be (null or not given: the leaf itself). Repeated rows are leaves of their
    own; a lone leaf is its own subroot, a lone subroot the root; an empty
    table has no rows. Texts are digested where they are read and never moved.
    """
    leaf = leaf_digest(*[F.col(c) for c in FIELDS])
    other = F.lit(None).cast("binary") if shown is None else shown
    rows = written(docs.select(_tree_key(F.col("lang")).alias("tree"), "doc_id", leaf.alias("digest"), other.alias("shown")), "merkle-leaves")
    leaves = written(with_places(rows, ["tree"], ["doc_id", "digest"], "merkle-sorted"), "merkle-places")
    rounds = append_log(leaves.select("tree", "at", "size", "digest"), "merkle-log")
    subroots = roots(rounds)
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"))
    tops = written(with_places(written(tops, "merkle-subroots"), ["tree"], ["key"], "merkle-langs"), "merkle-lang-places")
    top_rounds = append_log(tops.select("tree", "at", "size", "digest"), "merkle-top")
    root = roots(top_rounds)
    blocks = top_rounds[0].join(leaf_proofs(top_rounds, root.select("tree", F.lit(b"").alias("proof"))), ["tree", "block"]).join(root, "tree")
    # Per language, the proof of its subroot.
    placed = tops.withColumn("block", F.floor(F.col("at") / BLOCK)).select("tree", "block", "at", "key", F.col("digest").alias("subroot"))
    above = placed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(_subroot_proofs, "tree string, subroot binary, root binary, proof binary")
    above = written(above, "merkle-above")
    blocks = rounds[0].join(leaf_proofs(rounds, above.select("tree", "proof")), ["tree", "block"]).join(above.drop("proof"), "tree")
    placed = leaves.select("tree", F.floor(F.col("at") / BLOCK).alias("block"), "at", "doc_id", "digest", "shown")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf binary, subroot binary, root binary, proof binary, folded binary"
    return placed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(_row_proofs, schema)


def _block(blocks: pa.Table) -> tuple[dict, list[list[bytes]]]:
    (block,) = blocks.to_pylist()
    return block, block_steps(block["log"], block["leaves"], block["size"])


def _subroot_proofs(rows: pa.Table, blocks: pa.Table) -> pa.Table:
    block, steps = _block(blocks)
    proofs = [_leaf_proof(steps, at % BLOCK, block["proof"]) for at in rows["at"].to_pylist()]
    return pa.table([rows["key"], rows["subroot"], pa.array([block["root"]] * len(rows), pa.binary()), pa.array(proofs, pa.binary())], ["tree", "subroot", "root", "proof"])


def _row_proofs(rows: pa.Table, blocks: pa.Table) -> pa.Table:
    block, steps = _block(blocks)
    proofs = [_leaf_proof(steps, at % BLOCK, block["proof"]) for at in rows["at"].to_pylist()]
    leaves = rows["digest"].to_pylist()
    folded = [fold(leaf if shown is None else shown, proof) for leaf, shown, proof in zip(leaves, rows["shown"].to_pylist(), proofs, strict=True)]
    same = {name: pa.array([block[name]] * len(rows), pa.binary()) for name in ("subroot", "root")}
    return pa.table({"doc_id": rows["doc_id"], "leaf": rows["digest"], **same, "proof": pa.array(proofs, pa.binary()), "folded": pa.array(folded, pa.binary())})


def proof_digest(proofs: DataFrame) -> DataFrame:
    """``proofs`` with ``proof`` replaced by the SHA-256 hex of its siblings'
    digests as hex."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("proof")
            digests = [hashlib.sha256(siblings(p).hex().encode()).hexdigest() for p in batch.column(at).to_pylist()]
            yield batch.set_column(at, "proof", pa.array(digests))

    fields = ", ".join(f"`{f.name}` {'string' if f.name == 'proof' else f.dataType.simpleString()}" for f in proofs.schema)
    return python_ready(proofs).mapInArrow(digest, fields)
