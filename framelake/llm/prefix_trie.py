"""Conversation prefix trie over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest is 128 bits, four
lanes of 32 that add up a hash of each turn and its place: sums can be split
anywhere, so the prefixes of a conversation of any length are found by parts.

Conversations are cut into segments of ``SEGMENT`` turns and dealt to shards of
about ``SHARD`` turns. A shard enumerates the distinct digests of its prefixes,
gives each a slot by a minimal perfect hash (verified: the slot holds the very
digest, and all that share it the same last turn and parent), scatters its
counts into flat arrays by slot, and keeps the table: digests, parent slots,
depths. Shards know the same node, such as a first turn that a third of all
conversations share, each in part; the parts, one row per shard and node, add
up in a grouping.

What a node gives to those above it is given once, by the shard of its least
member: a node without children gives a leaf, a node its saved tokens. The
second pass scatters these into the shards' arrays and accumulates them through
the parent slots, deepest first. A segment's sum also counts for the earlier
segments of its conversation; it enters there at the last node. So no group is
larger than a shard, and no round is needed per level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import python_ready, written
from framelake.llm.ranks import ranked

HEADS = 9  # a conversation takes fewer turns than this from its base
GROUP = 5
SEGMENT = 4096
SHARD = 1 << 16
PIECE = 4096  # member ids of a piece of a node's list
LANES = 4
_LANE = (1 << 32) - 1
_CONV = ["anon", "conv"]  # of a conversation: its id is null, its id or 0
_NODE = ["depth", "hi", "lo"]
_GOLDEN, _MIX_1, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# ---------------------------------------------------------------------------
# Minimal perfect hash of 128-bit digests


def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    """64 bits of a digest, others for each level."""
    x = hi + (lo ^ np.uint64((level + 1) * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)) * _MIX_2
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """Slots 0 to n-1 for n distinct digests: a cascade of bit arrays, twice as
    long as the digests still without a place. A digest takes the first level
    at which no other falls on its bit; its slot is the number of bits before
    it. Lookups of other digests are recognised by the digest in the slot."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[np.ndarray] = []
        left = np.arange(len(hi))
        while len(left):
            size = 2 * len(left) + 1
            at = (_mixed(hi[left], lo[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            left = left[~alone[at]]
        self.starts = np.cumsum([0, *[int(level.sum()) for level in self.levels]])
        self.ranks = [np.cumsum(level) - 1 for level in self.levels]
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        slots = self._slots(hi, lo)
        self.hi[slots], self.lo[slots] = hi, lo
        if not (np.array_equal(self.hi[slots], hi) and np.array_equal(self.lo[slots], lo)):
            raise ValueError("digests are not distinct")

    def _slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        slots = np.full(len(hi), -1)
        left = np.arange(len(hi))
        for number, (level, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_mixed(hi[left], lo[left], number) % np.uint64(len(level))).astype(np.int64)
            found = level[at]
            slots[left[found]] = self.starts[number] + ranks[at[found]]
            left = left[~found]
        return slots

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that the table does not hold."""
        slots = self._slots(hi, lo)
        held = slots >= 0
        held[held] = (self.hi[slots[held]] == hi[held]) & (self.lo[slots[held]] == lo[held])
        return np.where(held, slots, -1)


# ---------------------------------------------------------------------------
# Prefixes


def turn_keys(conversations: DataFrame) -> DataFrame:
    """``anon, conv, turn, t1, t2, bytes``: a 128-bit hash of role and text, and
    the UTF-8 length of the text. Texts go no further."""
    conv_id = F.col("conv_id").cast("long")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    hashes = [F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2")]
    return conversations.select(conv_id.isNull().alias("anon"), F.coalesce(conv_id, F.lit(0)).alias("conv"), "turn", *hashes, F.octet_length(text).cast("long").alias("bytes"))


def borrowed(conv: Column, anon: Column) -> Column:
    """How many first turns a conversation takes from its base; one without id, none."""
    return F.when(anon, F.lit(0)).otherwise(F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt_turns(conversations: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """``anon, conv, at, t1, t2, bytes, ends``, a row per turn of each rebuilt
    conversation, ``at`` from 0, ``ends`` at its last; and ``anon, conv,
    turns``, a row per conversation, turnless ones included."""
    placed, pieces = ranked(written(turn_keys(conversations), "trie-turns"), _CONV, ["turn", "t1", "t2"], "trie-sorted")
    pieces = written(pieces, "trie-pieces")
    places = placed.join(pieces, [*_CONV, "part"]).withColumn("at", F.col("index") + F.col("shift"))
    head = F.array_sort(F.collect_list(F.struct("at", "t1", "t2", "bytes")))
    heads = places.where((F.col("at") < HEADS - 1) & ~F.col("anon") & (F.col("conv") % group == 0)).groupBy(F.col("conv").alias("base")).agg(head.alias("head"))
    known = pieces.groupBy(*_CONV).agg(F.max("size").alias("size")).withColumn("h", borrowed(F.col("conv"), F.col("anon")))
    known = known.withColumn("base", F.col("conv") - F.col("conv") % group).join(heads, "base", "left")
    known = known.withColumn("head", F.expr("filter(head, t -> t.at < h)")).withColumn("given", F.coalesce(F.size(F.when(~F.col("anon"), F.col("head"))), F.lit(0)).cast("long"))
    known = known.withColumn("given", F.greatest("given", F.lit(0).cast("long"))).withColumn("turns", F.greatest(F.col("size") - F.col("h"), F.lit(0)) + F.col("given"))
    known = written(known.select(*_CONV, "h", "given", "turns", "head"), "trie-conversations")
    last = (F.col("at") + 1 == F.col("turns")).alias("ends")
    columns = [*_CONV, "at", "t1", "t2", "bytes"]
    from_base = known.where("given > 0").select(*_CONV, "turns", F.inline("head")).select(*columns, last)
    # By conversation and part, so that a hot conversation is many keys.
    shifts = pieces.join(known.drop("head"), _CONV).select(*_CONV, "part", "shift", "h", "given", "turns")
    own = placed.join(shifts, [*_CONV, "part"]).withColumn("at", F.col("index") + F.col("shift") - F.col("h")).where("at >= 0")
    own = own.withColumn("at", F.col("at") + F.col("given")).select(*columns, last)
    return from_base.unionByName(own), known.select(*_CONV, "turns")


def _lanes(at: Column) -> list[Column]:
    """A turn's hash with its place, in lanes of 32 bits."""
    words = (F.xxhash64("t1", "t2", at), F.xxhash64(at, F.lit(2), "t2", "t1"))
    return [F.shiftrightunsigned(w, s).bitwiseAND(F.lit(_LANE)) for w in words for s in (32, 0)]


def _packed(lanes: list[Column]) -> list[Column]:
    low = [lane.bitwiseAND(F.lit(_LANE)) for lane in lanes]
    return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]


def prefixes(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``anon, conv, segment, depth, hi, lo, bytes, ends`` and the parent's
    ``up_hi, up_lo``, for every prefix, the empty one included."""
    names = [f"x{i}" for i in range(LANES)]
    cut = F.floor(F.col("at") / segment)
    hashed = turns.select(*_CONV, cut.alias("cut"), "at", "bytes", "ends", *[x.alias(n) for x, n in zip(_lanes(F.col("at")), names, strict=True)])
    # Up to 2^31 lanes add up to a long.
    totals = hashed.groupBy(*_CONV, "cut").agg(*[F.sum(n).bitwiseAND(F.lit(_LANE)).alias(n) for n in names])
    earlier = Window.partitionBy(*_CONV).orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*_CONV, "cut", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"o{i}") for i, n in enumerate(names)])
    within = Window.partitionBy(*_CONV, "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum(n).over(within) + F.col(f"o{i}")).alias(f"s{i}") for i, n in enumerate(names)]
    summed = hashed.join(offsets, [*_CONV, "cut"]).select(*_CONV, "at", "bytes", "ends", *names, *sums)
    here = _packed([F.col(f"s{i}") for i in range(LANES)])
    above = _packed([F.col(f"s{i}") - F.col(f"x{i}") for i in range(LANES)])
    digests = [c.alias(n) for c, n in zip([*here, *above], ("hi", "lo", "up_hi", "up_lo"), strict=True)]
    rows = summed.select(*_CONV, (F.col("at") + 1).alias("depth"), *digests, "bytes", "ends")
    zero = F.lit(0).cast("long")
    tops = lengths.select(*_CONV, *[zero.alias(c) for c in ("depth", "hi", "lo", "up_hi", "up_lo", "bytes")], (F.col("turns") == 0).alias("ends"))
    return rows.unionByName(tops).withColumn("segment", F.floor(F.col("depth") / segment))


def shard_of(anon: Column, conv: Column, segment: Column, shards: int) -> Column:
    """The shard of a conversation's segment; those of a group, which share
    turns, go together."""
    return F.pmod(F.xxhash64(anon, F.floor(conv / GROUP), segment), F.lit(shards))


# ---------------------------------------------------------------------------
# Node tables of the shards


def _u64(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False).view(np.uint64)


def _depth_digest(depth: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Prefixes of different lengths are different nodes whatever their sums."""
    return hi ^ (depth.astype(np.uint64) * _GOLDEN)


def node_table(table: pa.Table, segment: int) -> pa.Table:
    """The flat arrays of a shard, in the order of its slots, of its prefixes:
    members, the least of them, ends, and the parent's slot (-1: none, or in
    the segment before)."""
    depth, hi, lo = table["depth"].to_numpy(), _u64(table["hi"]), _u64(table["lo"])
    up_hi, up_lo, size = _u64(table["up_hi"]), _u64(table["up_lo"]), table["bytes"].to_numpy()
    key = _depth_digest(depth, hi)
    first = np.unique(np.stack((key, lo), axis=1), axis=0, return_index=True)[1]
    slots, n = SlotTable(key[first], lo[first]), len(first)
    at = slots.slots(key, lo)
    row = np.empty(n, dtype=np.int64)
    row[at[first]] = first
    for values in (depth, hi, up_hi, up_lo, size):
        if not np.array_equal(values[row[at]], values):
            raise ValueError("two prefixes share a digest")
    named = ~table["anon"].to_numpy()
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, at[named], table["conv"].to_numpy()[named])
    nameless = np.ones(n, dtype=bool)
    nameless[at[named]] = False
    ends = np.bincount(at[table["ends"].to_numpy()], minlength=n)
    parent = slots.slots(_depth_digest(depth[row] - 1, up_hi[row]), up_lo[row])
    parent[depth[row] % segment == 0] = -1
    columns = {
        "slot": np.arange(n), "parent": parent, "depth": depth[row], "hi": hi[row].view(np.int64), "lo": lo[row].view(np.int64),
        "up_hi": up_hi[row].view(np.int64), "up_lo": up_lo[row].view(np.int64), "bytes": size[row],
        "members": np.bincount(at, minlength=n), "least": pa.array(least, mask=nameless), "ends": ends,
    }
    return pa.table(columns)


_TABLE_SCHEMA = "shard long, slot long, parent long, depth long, hi long, lo long, up_hi long, up_lo long, bytes long, members long, least long, ends long"


def node_tables(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``node_table`` of each ``shard`` of the prefixes ``rows``."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        found = node_table(table, segment)
        return found.add_column(0, "shard", pa.array([key[0].as_py()] * found.num_rows, pa.int64()))

    return python_ready(rows).groupBy("shard").applyInArrow(build, _TABLE_SCHEMA)


def accumulate(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values`` of each node with those of all nodes below it: through the
    parent slots (-1: none), one depth at a time, deepest first."""
    total = values.copy()
    order = np.argsort(depth, kind="stable")
    for nodes in reversed(np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)):
        below = nodes[parent[nodes] >= 0]
        np.add.at(total, parent[below], total[below])
    return total


def _subtrees(table: pa.Table) -> pa.Table:
    """Second pass over a shard: what its nodes give to each of their ancestors in it."""
    table = table.sort_by("slot")
    parent, depth, least = table["parent"].to_numpy(), table["depth"].to_numpy(), table["of"]
    own = table["own"].to_numpy()
    children = np.bincount(parent[own & (parent >= 0)], minlength=len(parent))
    up = least.take(pa.array(np.maximum(parent, 0)))
    sums = {name: accumulate(parent, depth, table[name].to_numpy()) for name in ("leaves", "saved")}
    return pa.table({**{name: table[name] for name in _NODE}, "n_children": children, "n_leaves": sums["leaves"], "saved_tokens": sums["saved"], "up": pa.compute.if_else(pa.array(own & (parent >= 0)), up, None)})


def ending_members(rows: DataFrame) -> DataFrame:
    """``depth, hi, lo, ends_sha256``: the digest of the ids of the
    conversations that end at a node, ascending, joined by commas. Ids are
    packed into pieces where ranges of them are, so that a node where very many
    end is a few rows in the task that digests them in turn."""
    schema = "depth long, hi long, lo long, first long, ids string"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> tuple:
            return (*node, ids[0], ",".join("" if i is None else str(i) for i in ids))

        for batch in batches:
            out = []
            for *at, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (at != node or len(ids) == PIECE):
                    out.append(piece())
                    ids = []
                node = at
                ids.append(conv_id)
            yield _rows(out)
        if ids:
            yield _rows([piece()])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)], ["depth", "hi", "lo", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = at, hashlib.sha256(ids.encode())
            yield _digests(out)
        if node is not None:
            yield _digests([(*node, sha.hexdigest())])

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(columns)], ["depth", "hi", "lo", "ends_sha256"])

    ended = python_ready(rows).where("ends").select(*_NODE, F.when(~F.col("anon"), F.col("conv")).alias("conv_id"))
    order = [*_NODE, F.col("conv_id").asc_nulls_first()]
    pieces = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, schema)
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, F.col("first").asc_nulls_first()).select(*_NODE, "ids").mapInArrow(digest, "depth long, hi long, lo long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations (columns
    ``conv_id, turn, role, text``; others are not read): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, null first, equal ones by a hash of role and
    text; repeated rows are turns of their own. Null roles and texts are empty.
    Rows without ``conv_id`` are one conversation, which takes nothing from
    others, whose id is the greatest as a member, is written as an empty text
    and comes first among the ends. An empty table has no node, not even the
    root.
    """
    turns, lengths = rebuilt_turns(conversations)
    rows = written(prefixes(turns, lengths, segment), "trie-prefixes")
    shards = -(-rows.count() // shard) or 1
    of_row = shard_of(F.col("anon"), F.col("conv"), F.col("segment"), shards)
    parts = written(node_tables(rows.withColumn("shard", of_row), segment), "trie-parts")
    same = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.raise_error(F.lit("two prefixes share a digest"))).alias(c)
    nodes = parts.groupBy(*_NODE).agg(F.sum("members").alias("n_convs"), F.min("least").alias("of"), F.sum("ends").alias("n_ends"), *[same(c) for c in ("up_hi", "up_lo", "bytes")])
    # Each node is given once, by the shard of its least member.
    here = F.floor(F.col("depth") / segment)
    giver = shard_of(F.col("of").isNull(), F.coalesce("of", F.lit(0)), here, shards)
    nodes = nodes.withColumn("leaf", (F.col("n_convs") == F.col("n_ends")).cast("long")).withColumn("save", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("giver", giver)
    nodes = written(nodes, "trie-nodes")
    carried = _carried(nodes, rows, segment, shards)
    told = parts.select("shard", "slot", "parent", *_NODE).join(nodes.select(*_NODE, "of", "leaf", "save", "giver"), _NODE)
    told = told.withColumn("own", F.col("giver") == F.col("shard")).join(carried, ["shard", *_NODE], "left")
    given = [(F.when(F.col("own"), F.col(c)).otherwise(F.lit(0)) + F.coalesce(f"more_{c}", F.lit(0))).cast("long").alias(n) for c, n in (("leaf", "leaves"), ("save", "saved"))]
    told = told.select("shard", "slot", "parent", *_NODE, "of", "own", *given)
    found = python_ready(told).groupBy("shard").applyInArrow(_subtrees, "depth long, hi long, lo long, n_children long, n_leaves long, saved_tokens long, up long")
    counts = ("n_children", "n_leaves", "saved_tokens")
    # Children whose parent is in the segment before are found by its digest.
    apart = nodes.where((F.col("depth") > 0) & (F.col("depth") % segment == 0)).select((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"), *[F.col(c).alias(f"child_{c}") for c in _NODE])
    above = apart.join(nodes.select(*_NODE, F.col("of").alias("up")), _NODE).select(*[F.col(f"child_{c}").alias(c) for c in _NODE], *[F.lit(0).alias(c) for c in counts], "up")
    extra = apart.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children")).select(*_NODE, "n_children", F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), F.lit(None).cast("long").alias("up"))
    summed = found.unionByName(above).unionByName(extra).groupBy(*_NODE).agg(*[F.sum(c).alias(c) for c in counts], F.max("up").alias("parent_conv_id"))
    none = F.sha2(F.lit(""), 256)
    out = nodes.select(*_NODE, F.col("of").alias("conv_id"), "n_convs").join(summed, _NODE).join(ending_members(rows), _NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", *counts, F.coalesce("ends_sha256", none).alias("ends_sha256"))


def _carried(nodes: DataFrame, rows: DataFrame, segment: int, shards: int) -> DataFrame:
    """``shard, depth, hi, lo, more_leaf, more_save``: what the later segments
    of a conversation give enters each earlier one at its last node."""
    here = F.floor(F.col("depth") / segment)
    key = [F.col("of").isNull().alias("anon"), F.coalesce("of", F.lit(0)).alias("conv"), here.alias("segment")]
    totals = nodes.where((F.col("leaf") > 0) | (F.col("save") > 0)).groupBy(*key).agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    # A segment without anything to give still hands on what comes after it.
    ends = rows.where(F.col("depth") % segment == segment - 1).select(*_CONV, "segment", *_NODE)
    steps = ends.join(totals, [*_CONV, "segment"], "full")
    later = Window.partitionBy(*_CONV).orderBy("segment").rowsBetween(1, Window.unboundedFollowing)
    steps = steps.select(*_CONV, "segment", *_NODE, *[F.sum(F.coalesce(c, F.lit(0))).over(later).alias(f"more_{c}") for c in ("leaf", "save")])
    steps = steps.where(F.col("depth").isNotNull() & ((F.col("more_leaf") > 0) | (F.col("more_save") > 0)))
    shard = shard_of(F.col("anon"), F.col("conv"), F.col("segment"), shards)
    return steps.groupBy(shard.alias("shard"), *_NODE).agg(F.sum("more_leaf").alias("more_leaf"), F.sum("more_save").alias("more_save"))
