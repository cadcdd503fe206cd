"""Randomized decode check: messages built and serialized with the protobuf
runtime, decoded by the Spark column function, compared field by field under
the connector's presence rules."""

from __future__ import annotations

import random

from framelake.operators.protobuf import from_protobuf, message_class
from framelake.schemas import descriptor_set, file_proto

FIELDS = [
    ("s", 1, "string"), ("b", 2, "bytes"), ("i32", 3, "int32"), ("i64", 4, "int64"), ("u32", 5, "uint32"),
    ("s64", 6, "sint64"), ("flag", 7, "bool"), ("d", 8, "double"), ("nums", 9, "repeated int64"),
    ("tags", 10, "map<string,string>"), ("inner", 11, "t.Inner"), ("items", 12, "repeated t.Inner"),
]


def _files():
    inner = ("Inner", [("name", 1, "string"), ("n", 2, "int32")])
    return [file_proto("t/rand.proto", "t", [inner, ("Rand", FIELDS)])]


def _random_message(cls, inner_cls, rng: random.Random):
    m = cls()
    if rng.random() < 0.7:
        m.s = rng.choice(["", "a", "héllo", "x" * rng.randrange(0, 40)])
    if rng.random() < 0.5:
        m.b = bytes(rng.randrange(256) for _ in range(rng.randrange(0, 6)))
    if rng.random() < 0.7:
        m.i32 = rng.choice([0, 1, -1, 2**31 - 1, -(2**31)])
    if rng.random() < 0.7:
        m.i64 = rng.choice([0, 1, -1, 2**63 - 1, -(2**63), 1700000000000])
    if rng.random() < 0.5:
        m.u32 = rng.choice([0, 1, 2**31, 2**32 - 1])
    if rng.random() < 0.5:
        m.s64 = rng.choice([0, -5, 5, -(2**40)])
    if rng.random() < 0.5:
        m.flag = rng.random() < 0.5
    if rng.random() < 0.5:
        m.d = rng.choice([0.0, 1.5, -2.25, 1e300])
    m.nums.extend(rng.randrange(-(10**12), 10**12) for _ in range(rng.randrange(0, 4)))
    for k in range(rng.randrange(0, 3)):
        m.tags[f"k{k}"] = rng.choice(["", "v", "w"])
    if rng.random() < 0.5:
        m.inner.name = rng.choice(["", "in"])
        m.inner.n = rng.choice([0, 7])
    for _ in range(rng.randrange(0, 3)):
        it = m.items.add()
        it.name = rng.choice(["", "it"])
    return m


def _expected(m):
    """The decoded row: absent fields (zero scalars, unset messages) are NULL,
    empty repeated and map fields empty."""
    def inner(x):
        return {"name": x.name or None, "n": x.n or None}

    u32 = m.u32 - 2**32 if m.u32 >= 2**31 else m.u32
    return {
        "s": m.s or None, "b": m.b or None, "i32": m.i32 or None, "i64": m.i64 or None, "u32": u32 or None,
        "s64": m.s64 or None, "flag": True if m.flag else None, "d": m.d or None,
        "nums": list(m.nums), "tags": dict(m.tags),
        "inner": inner(m.inner) if m.HasField("inner") else None,
        "items": [inner(x) for x in m.items],
    }


def _normal(row):
    out = row.asDict(recursive=True)
    if out["b"] is not None:
        out["b"] = bytes(out["b"])
    return out


def test_decode_matches_runtime_on_random_messages(spark):
    ds = descriptor_set(_files())
    cls = message_class(ds, "t.Rand")
    inner_cls = message_class(ds, "t.Inner")
    rng = random.Random(7)
    messages = [_random_message(cls, inner_cls, rng) for _ in range(1500)]
    df = spark.createDataFrame([(i, bytearray(m.SerializeToString())) for i, m in enumerate(messages)], "i int, v binary")
    got = {r.i: r.m for r in df.select("i", from_protobuf("v", "t.Rand", ds).alias("m")).collect()}
    bad = [(i, _expected(m), _normal(got[i])) for i, m in enumerate(messages) if _expected(m) != _normal(got[i])]
    assert not bad, bad[:3]
