"""Near-duplicates by min-max hashing.

A document is the set of its distinct word pairs. Under each of
``PERMUTATIONS`` hash functions both the least and the greatest value of the
set are kept: each agrees between two sets with probability equal to their
Jaccard similarity, so half the hash evaluations give ``2 * PERMUTATIONS``
values. They are cut into ``BANDS`` bands of ``ROWS`` values; documents with an
equal band share a bucket. Two sets with similarity s share none with
probability ``(1 - s ** ROWS) ** BANDS``: 3 in a million at 0.8.

All pairs of a bucket are not needed to connect its documents. First each is
held against the bucket's hub, the document with the most neighbours, then
against the one in another component that its signature is most like. Documents
that had such a partner are few by now. At last they are brought together by
hub with their full sets, in tiles, and all their pairs that are still in
different components, share a bucket's hub and are near by signature are
verified where they lie: a task gives back only the links that join components.
A link counts when the full sets are similar enough. Equal texts are one node
from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.bloom import bloom_blocks, marked_hits, possible_hits
from framelake.llm.common import python_ready, text_hash, written
from framelake.llm.components import connected_components
from framelake.llm.simhash_dedup import Forest

SHINGLE = 2
SIMILARITY_PERCENT = 80
PERMUTATIONS = 126
ROWS = 6
BANDS = 2 * PERMUTATIONS // ROWS
# Of a signature's 252 values 202 agree on average at the threshold, fewer than
# 177 (70 %) once in 10,000 pairs; such pairs are verified only with hubs.
MIN_AGREE = 177
TILE = 512
TILE_SHINGLES = 1 << 18  # of a tile with full sets, unless one set has more
FILTER_BLOCKS = 1 << 18  # of Bloom filters, which take 19 MB at most
SALT = 1024  # members that a task holds against one copy of their hub
_CHUNK = 1 << 17  # hashes at a time: in cache
_WORDS = 1 << 18
_PRIME_1, _PRIME_2, _PRIME_3 = (np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_draw = np.random.Generator(np.random.PCG64(12))
_FACTORS, _FLIPS = (_draw.integers(0, 1 << 64, PERMUTATIONS, dtype=np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()  # of a Python worker


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _PRIME_2
    x = (x ^ (x >> np.uint64(29))) * _PRIME_3
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """The set of a UTF-8 text, as ascending 64-bit hashes: its distinct pairs
    of neighbouring words, A-Z lowered; a lone word as one; else empty."""
    words = text.lower().split()
    if len(_words) > _WORDS:
        _words.clear()
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        return _mixed(hashes * _PRIME_3)
    return np.unique(_mixed(hashes[:-1] * _PRIME_1 + (hashes[1:] ^ (hashes[1:] >> np.uint64(31)))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row per (non-empty) set: the minima, then the maxima."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    values = np.concatenate(sets)
    out = np.empty((len(sets), 2 * PERMUTATIONS), dtype=np.uint32)
    for p in range(PERMUTATIONS):
        hashed = (((values ^ _FLIPS[p]) * _FACTORS[p]) >> np.uint64(32)).astype(np.uint32)
        out[:, p] = np.minimum.reduceat(hashed, starts)
        out[:, PERMUTATIONS + p] = np.maximum.reduceat(hashed, starts)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """64-bit bucket keys, the band's number included."""
    bands = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _PRIME_1, bands.shape[:2])
    for row in range(ROWS):
        keys = _mixed(keys ^ (bands[:, :, row] * _PRIME_1))
    return keys


def signed_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n_shingles, keys, signature`` of each row: the text's
    hash, the size of its set, the bucket keys and the low byte of each value
    (null for an empty set)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("node", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            at = 0
            while at < len(texts):
                first, sets, held = at, [], 0
                while at < len(texts) and held < _CHUNK:
                    sets.append(shingle_set(texts[at].as_py() or b""))
                    held += len(sets[-1])
                    at += 1
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, low = [None] * len(sets), [None] * len(sets)
                if full:
                    values = signatures([sets[i] for i in full])
                    for i, k, v in zip(full, band_keys(values).view(np.int64), values.astype(np.uint8), strict=True):
                        keys[i], low[i] = k, v.tobytes()
                ids, nodes = (batch.column(c).slice(first, at - first) for c in (0, 1))
                columns = [ids, nodes, pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return python_ready(docs).select("doc_id", text_hash("text").alias("node"), "text").mapInArrow(run, schema)


def one_per_node(rows: DataFrame) -> DataFrame:
    """``node, n_shingles, keys, signature``, once for each node. Only rows
    whose node a Bloom filter of the repeated ones may hold are shuffled."""
    rows = rows.select("node", "n_shingles", "keys", "signature").withColumn("key", F.col("node"))
    repeated = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    bloom = written(bloom_blocks(repeated, FILTER_BLOCKS), "minhash-repeated")
    marked = marked_hits(rows, bloom, "repeated", FILTER_BLOCKS).drop("key")
    several = written(marked.where("repeated").drop("repeated").dropDuplicates(["node"]), "minhash-nodes")
    return marked.where("NOT repeated").drop("repeated").unionByName(several)


def bucket_members(nodes: DataFrame) -> DataFrame:
    """``key, node, n_shingles, hub, hub_size`` of the buckets of several
    nodes. The hub is the node whose own buckets have most members in all.
    Most keys have one node; a Bloom filter of the others keeps them out of
    the join."""
    entries = nodes.select(F.explode("keys").alias("key"), "node", "n_shingles")
    shared = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-shared-keys")
    possible = possible_hits(entries, bloom_blocks(shared.select("key"), FILTER_BLOCKS), FILTER_BLOCKS)
    members = written(possible.join(shared, "key"), "minhash-shared")
    weighed = members.drop("n").join(members.groupBy("node").agg(F.sum("n").alias("weight")), "node")
    hub = F.max(F.struct("weight", F.col("node").alias("hub"), F.col("n_shingles").alias("hub_size"))).alias("h")
    return weighed.drop("weight").join(weighed.groupBy("key").agg(hub).select("key", "h.hub", "h.hub_size"), "key")


def _sizes_allow(a: str, b: str):
    return 100 * F.least(a, b) >= SIMILARITY_PERCENT * F.greatest(a, b)


def hub_pairs(members: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a node and its bucket's hub."""
    met = members.where((F.col("node") != F.col("hub")) & _sizes_allow("n_shingles", "hub_size"))
    return met.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def open_members(members: DataFrame, components: DataFrame) -> DataFrame:
    """``members`` with their component as ``label``, of the buckets that have several."""
    labelled = members.select("key", "node", "n_shingles", "hub").join(components.withColumnRenamed("component", "label"), "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    several = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    return labelled.join(several, "key").select("key", "node", "n_shingles", "hub", "label")


def _near(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Members of two tiles, by index, of different labels, whose sizes allow
    the similarity, and in how many values they agree, if in ``MIN_AGREE``."""
    least, most = np.minimum.outer(a["size"], b["size"]), np.maximum.outer(a["size"], b["size"])
    i, j = np.nonzero((a["label"][:, None] != b["label"][None, :]) & (100 * least >= SIMILARITY_PERCENT * most))
    for at in range(0, len(i), 1 << 14):
        x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        agree = (a["signature"][x] == b["signature"][y]).sum(axis=1)
        near = agree >= MIN_AGREE
        yield x[near], y[near], agree[near]


def _tile_pairs(rows: DataFrame, group: str, tiles: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Pairs ``a, b`` of tiles of a ``group``'s rows, as arrays of structs; a
    group is cut into as many as ``tiles`` says, so a large one is many tasks.
    A lone tile meets itself where it lies."""
    part = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("tiles")).cast("int")
    cut = rows.join(tiles, group).groupBy(group, part.alias("part"), "tiles").agg(F.collect_list(F.struct(*fields)).alias("members"))
    cut = written(cut, name)
    lone, several = cut.where("tiles = 1"), cut.where("tiles > 1")
    visits = several.select(group, F.col("members").alias("a"), F.explode(F.sequence(F.col("part"), F.col("tiles") - 1)).alias("part"))
    met = visits.join(several.select(group, "part", F.col("members").alias("b")), [group, "part"]).select("a", "b")
    return lone.select(F.col("members").alias("a"), F.col("members").alias("b")).unionByName(met)


def _arrays(members: pa.Array) -> dict:
    signature = np.frombuffer(b"".join(members.field("signature").to_pylist()), np.uint8).reshape(len(members), -1)
    return {"node": members.field("node").to_numpy(), "size": members.field("n_shingles").to_numpy(), "label": members.field("label").to_numpy(), "signature": signature}


def best_pairs(members: DataFrame, nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs ``a, b`` of each node of the open buckets and the one of another
    label that its signature is most like, unless it is ruled out."""
    tiles = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    rows = members.join(nodes.select("node", "signature"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            partner: dict[int, tuple[int, int]] = {}  # agreement and node
            for row in range(batch.num_rows):
                a, b = (_arrays(batch.column(c)[row].values) for c in (0, 1))
                for i, j, agree in _near(a, b):
                    for x, y, n in zip(a["node"][i].tolist(), b["node"][j].tolist(), agree.tolist(), strict=True):
                        partner[x] = max(partner.get(x, (0, 0)), (n, y))
                        partner[y] = max(partner.get(y, (0, 0)), (n, x))
            columns = [pa.array(c, pa.int64()) for c in (list(partner), [y for _, y in partner.values()], [n for n, _ in partner.values()])]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "agree"])

    pairs = _tile_pairs(rows, "key", tiles, ["node", "n_shingles", "label", "signature"], "minhash-tiles")
    near = python_ready(pairs).mapInArrow(run, "a long, b long, agree long")
    near = near.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("m"))
    return near.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two (ascending) sets are similar enough."""
    places = np.searchsorted(a, b)
    places[places == len(a)] = 0
    both = int((a[places] == b).sum())
    return 100 * both >= SIMILARITY_PERCENT * (len(a) + len(b) - both)


def open_links(members: DataFrame, candidates: DataFrame, nodes: DataFrame, texts: DataFrame, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """Links ``a, b`` that join the components of all near pairs of the
    ``candidates`` (``node``) in the open buckets, verified on full sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column(1).cast(pa.large_binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["node", "shingles"])

    full = written(python_ready(texts.join(candidates, "node", "left_semi")).mapInArrow(sets, "node long, shingles binary"), "minhash-sets")
    rows = written(members.join(candidates, "node", "left_semi").select("hub", "node", "n_shingles", "label").distinct(), "minhash-left")
    tiles = rows.groupBy("hub").agg(F.ceil(F.sum("n_shingles") / F.lit(tile_shingles)).cast("int").alias("tiles"))
    rows = rows.join(nodes.select("node", "signature"), "node").join(full, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()  # of labels
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                (a, x), (b, y) = ((_arrays(m), [np.frombuffer(s, np.uint64) for s in m.field("shingles").to_pylist()]) for m in (batch.column(c)[row].values for c in (0, 1)))
                for i, j, agree in _near(a, b):
                    order = np.argsort(-agree, kind="stable")
                    for p, q in zip(i[order].tolist(), j[order].tolist(), strict=True):
                        left, right = (forest.root(int(v)) for v in (a["label"][p], b["label"][q]))
                        if left != right and similar(x[p], y[q]):
                            forest.link(left, right)
                            found.append((a["node"][p], b["node"][q]))
            yield pa.RecordBatch.from_arrays([pa.array([f[side] for f in found], pa.int64()) for side in (0, 1)], ["a", "b"])

    pairs = _tile_pairs(rows, "hub", tiles, ["node", "n_shingles", "label", "signature", "shingles"], "minhash-full")
    return written(python_ready(pairs).mapInArrow(run, "a long, b long"), "minhash-links")


def node_texts(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text`` of some nodes, each once, and of a few more: those that
    a Bloom filter of the nodes lets through. No other text is shuffled."""
    keyed = docs.select(text_hash("text").alias("key"), "text")
    possible = possible_hits(keyed, bloom_blocks(nodes.select(F.col("node").alias("key")), FILTER_BLOCKS), FILTER_BLOCKS)
    return possible.groupBy(F.col("key").alias("node")).agg(F.first("text").alias("text"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough, by the ``texts`` of their
    nodes. A task reads a hub's text
    once and holds up to about ``SALT`` members against it, one at a time."""
    dealt = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(SALT)).alias("salts"))
    pairs = pairs.join(dealt, "b").select("a", "b", F.pmod(F.xxhash64("a", "b"), F.col("salts")).alias("salt"))
    members = pairs.join(texts.withColumnRenamed("node", "a"), "a").select("b", "salt", "a", "text")
    hubs = pairs.select("b", "salt").distinct().join(texts.withColumnRenamed("node", "b"), "b").select("b", "salt", F.lit(None).cast("long").alias("a"), "text")
    rows = members.union(hubs).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            a, b, texts = batch.column(2).to_pylist(), batch.column(0).to_pylist(), batch.column(3).cast(pa.large_binary())
            found = []
            for at, node in enumerate(a):
                own = shingle_set(texts[at].as_py())
                if node is None:
                    hub = own
                    continue
                if similar(hub, own):
                    found.append((node, b[at]))
            yield pa.RecordBatch.from_arrays([pa.array([f[side] for f in found], pa.int64()) for side in (0, 1)], ["a", "b"])

    return written(python_ready(rows).mapInArrow(run, "a long, b long"), "minhash-links")


def node_components(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, component`` of the nodes that are linked to another."""
    members = written(bucket_members(nodes), "minhash-members")
    shared = written(members.select("node").distinct(), "minhash-shared-nodes")
    texts = written(node_texts(shared, docs), "minhash-texts")
    links = verified(written(hub_pairs(members), "minhash-pairs"), texts)
    components = connected_components(links, "minhash-components")
    left = written(open_members(members, components), "minhash-open")
    pairs = written(best_pairs(left, nodes), "minhash-best")
    links = links.union(verified(pairs, texts))
    components = connected_components(links, "minhash-components")
    left = open_members(members, components)
    links = links.union(open_links(left, _ends(pairs), nodes, texts))
    return connected_components(links, "minhash-components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, n_shingles, component_id, kept`` for each row of ``docs``
    (columns ``doc_id`` and ``text``; others are not read).

    Rows link where ``SIMILARITY_PERCENT`` of the union of their sets is in
    both; ``component_id`` is the least ``doc_id`` that a row reaches, itself
    included, and a row is kept if it is its own. A text without words, or a
    null one, has an empty set and links with nothing. Rows with a null
    ``doc_id`` link, but give their component no name unless all of it has none
    (then null, and kept). Repeated rows get equal results, an empty table
    gives none.
    """
    rows = written(signed_rows(docs), "minhash-rows")
    nodes = one_per_node(rows.where("n_shingles > 0"))
    components = node_components(nodes, docs)
    least = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(components, "node", "left")
    least = least.withColumn("component", F.coalesce("component", "node"))
    names = least.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = least.join(names, "component").select("node", "component_id")
    full = rows.where("n_shingles > 0").select("doc_id", "node", "n_shingles").join(named, "node")
    empty = rows.where("n_shingles = 0").select("node", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return full.unionByName(empty).select("doc_id", F.col("node").alias("hash"), "n_shingles", "component_id", kept.alias("kept"))
