"""SimHash near-duplicates by tiled exact comparison.

Every text has a 64-bit fingerprint: the majority, bit by bit, of the XXH64
hashes of its word shingles. Equal fingerprints collapse first. The distinct
ones are dealt into tiles by the population counts of their four 16-bit
quarters; two fingerprints within ``RADIUS`` bits have quarter counts whose
differences add up to at most ``RADIUS``, so every other pair of tiles is
skipped. (The skip by quarters contains the skip by the whole count.) What is
left is compared exactly, all against all, by exclusive-or and bit counts.

A tile holds at most about ``TILE`` fingerprints: a cell of equal counts is cut
by hash into as many tiles as its size asks for, and pairs of tiles, not cells,
are dealt out, so a cell with a third of the fingerprints is many tasks. From
its pairs of tiles a task keeps a spanning forest of the links, so a group of
thousands of near copies gives thousands of edges, not millions.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import id_keys, python_ready, text_hash, written
from framelake.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 1024
QUARTERS = 4

_LANES = np.uint64(0x0101010101010101)


def shingles(text: bytes, size: int = SHINGLE) -> list[bytes]:
    """Space-joined runs of ``size`` words of the A-Z-lower-cased UTF-8 text;
    all words if there are fewer; nothing if there is none."""
    words = text.lower().split()
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprints(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text, as unsigned 64-bit integers.

    Bits are counted eight at a time: byte lanes of a word add up to 255
    hashes without overflow, so hashes are summed in runs of 255."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for at, text in enumerate(texts):
        own = shingles(text, size)
        counts[at] = len(own)
        hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, own, itertools.repeat(SEED)), np.uint64, len(own)))
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    values = np.concatenate(hashes)
    starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
    runs = -(-counts[full] // 255)
    run_starts = np.repeat(starts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    first_run = np.cumsum(runs) - runs
    result = np.zeros(len(full), dtype=np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((values >> np.uint64(bit)) & _LANES, run_starts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        majority = (2 * ones > counts[full][:, None]).astype(np.uint8)
        result |= np.ascontiguousarray(majority).view(np.uint64).ravel() << np.uint64(bit)
    out[full] = result
    return out


def _parts(texts: list[bytes], size: int = 1 << 22) -> Iterator[list[bytes]]:
    """``texts`` in runs of about ``size`` bytes, or one longer text: the hashes
    of a run are in memory together."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def fingerprint_rows(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, hash, fingerprint`` of each row; ``fingerprint`` as a signed long."""
    fields = [docs.schema["doc_id"], T.StructField("hash", T.LongType()), T.StructField("fingerprint", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()]
            prints = pa.array(np.concatenate([fingerprints(part, size) for part in _parts(texts)] or [np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "hash", "fingerprint"])

    return python_ready(docs).select("doc_id", text_hash("text").alias("hash"), "text").mapInArrow(run, T.StructType(fields))


def _quarter_counts(fingerprint: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fingerprint, 16 * q).bitwiseAND(F.lit(0xFFFF))).cast("int") for q in range(QUARTERS)]


def _cell(counts: list[Column]) -> Column:
    cell = F.lit(0)
    for c in counts:
        cell = cell * 17 + c
    return cell.cast("int")


def tile_pairs(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Pairs of tiles ``a, b`` (arrays of fingerprints) that may hold linked
    ones, and ``own`` where both are the same tile. There are 17^4 cells, so
    the table of their sizes that is broadcast has at most 83,521 rows."""
    counts = _quarter_counts(F.col("fingerprint"))
    celled = prints.withColumn("cell", _cell(counts))
    sizes = written(celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles")), "simhash-cells")
    part = F.pmod(F.xxhash64("fingerprint", F.lit("tile")), F.col("tiles")).cast("int")
    tiles = celled.join(F.broadcast(sizes), "cell").groupBy("cell", part.alias("part")).agg(F.collect_list("fingerprint").alias("members"))
    tiles = written(tiles, "simhash-tiles")
    # Of two neighbouring cells the one that comes first visits the other.
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius and s >= (0,) * QUARTERS]
    of_cell = [F.floor(F.col("cell") / F.lit(17 ** (QUARTERS - 1 - q))).cast("int") % 17 for q in range(QUARTERS)]
    step = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f"s{q}") for q, v in enumerate(s)]) for s in steps])).alias("step")
    visits = tiles.select("cell", "part", F.col("members").alias("a"), *[c.alias(f"c{q}") for q, c in enumerate(of_cell)], step)
    moved = [F.col(f"c{q}") + F.col(f"step.s{q}") for q in range(QUARTERS)]
    for m in moved:
        visits = visits.where(m.between(0, 16))
    visits = visits.select(F.col("cell").alias("from_cell"), F.col("part").alias("from_part"), "a", _cell(moved).alias("cell"))
    visits = visits.join(F.broadcast(sizes), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")
    visits = visits.where((F.col("from_cell") != F.col("cell")) | (F.col("from_part") <= F.col("part")))
    pairs = visits.join(tiles.withColumnRenamed("members", "b"), ["cell", "part"])
    return pairs.select("a", "b", ((F.col("from_cell") == F.col("cell")) & (F.col("from_part") == F.col("part"))).alias("own"))


def linked(a: np.ndarray, b: np.ndarray, own: bool, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of fingerprints, of the links between the members of two tiles."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if own:
        near = np.triu(near, 1)
    rows = near.any(axis=1)
    if not rows.any():
        return a[:0], b[:0]
    columns = near.any(axis=0)
    near, a, b = near[rows][:, columns], a[rows], b[columns]
    if len(a) * len(b) <= 16:
        i, j = np.nonzero(near)
        return a[i], b[j]
    # Least label over the links until nothing changes; a member of both sides is one node.
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    at_a, at_b = at[: len(a)], at[len(a) :]
    i, j = np.nonzero(near)
    left, right = at_a[i], at_b[j]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class Forest:
    """Union-find over the nodes that have links."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    forest = Forest()
    for batch in batches:
        for a, b, own in zip(batch["a"], batch["b"], batch["own"], strict=True):
            x, y = linked(np.asarray(a, dtype=np.int64).view(np.uint64), np.asarray(b, dtype=np.int64).view(np.uint64), own, radius)
            for u, v in zip(x.view(np.int64).tolist(), y.view(np.int64).tolist(), strict=True):
                forest.link(u, v)
    nodes = list(forest.parent)
    yield pd.DataFrame({"a": pd.Series(nodes, dtype="int64"), "b": pd.Series([forest.root(x) for x in nodes], dtype="int64")})


def link_edges(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` that connect exactly the distinct fingerprints that links connect."""
    pairs = python_ready(tile_pairs(prints, radius, tile))
    return pairs.mapInPandas(lambda batches: _links(batches, radius), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``doc_id, hash, fingerprint, component, component_id`` for each row of
    ``docs`` (columns ``doc_id`` and ``text``; others are not read).

    Rows link where their fingerprints differ in ``radius`` bits at most;
    ``component_id`` is the least ``doc_id`` that a row reaches, itself
    included, ``component`` the least linked fingerprint and ``hash`` the key
    of the text. Null and empty texts have fingerprint 0 and link like any
    other; rows with a null ``doc_id`` link, but give their component no name
    unless all of it has none (then null). Repeated rows get equal results, an
    empty table gives none.
    """
    rows = written(fingerprint_rows(docs, size), "simhash-rows")
    prints = rows.select("fingerprint").distinct()
    components = connected_components(link_edges(prints, radius, tile), "simhash-components")
    known = rows.groupBy("fingerprint", "doc_id").agg(F.min("hash").alias("hash"))
    least = known.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    grouped = least.join(components, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "doc_id", F.coalesce("component", "fingerprint").alias("component"))
    names = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(names, "component").select("fingerprint", "component", "component_id")
    out = rows.join(named, "fingerprint")
    return out.select("doc_id", "hash", "fingerprint", "component", "component_id")


def keepers(rows: DataFrame) -> DataFrame:
    """``doc_id, hash`` of one row per component of ``near_duplicates``: the
    least ``doc_id``, of equal ones the least text key."""
    named = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return named.groupBy("component", "doc_id").agg(F.min("hash").alias("hash")).select("doc_id", "hash")


def deduplicate(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept: one per component. Of
    rows equal in ``doc_id`` and text the first by its other columns' hash stays."""
    keys = ["id_key", "no_id", "hash"]
    kept = keepers(near_duplicates(docs, size, radius, tile)).select(*id_keys(), "hash")
    packed = docs.select(F.struct("*").alias("row"), *id_keys(), text_hash("text").alias("hash"))
    met = packed.join(kept, keys, "left_semi")
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row")))
    return met.withColumn("turn", turn).where("turn = 1").select("row.*")
