"""Framing vectors (hand-built bytes) through the Catalyst expressions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framelake.functions.framing import (
    frame,
    frame_outcome,
    message_index_bytes,
    register_sql_functions,
    schema_id,
    strip_framing,
    varint_bytes,
    zigzag,
)

# (value hex, stripped hex or None, outcome, schema id)
VECTORS = [
    ("000000007B00010203", "010203", "framed", 123),  # id 123, no indexes
    ("00000000070405AC02AABB", "AABB", "framed", 7),  # indexes 5 and 300
    (None, None, "null_value", None),
    ("0000000000", None, "too_short", None),  # five zero bytes
    ("0A03666F6F", "0A03666F6F", "plain", None),  # plain protobuf
    ("010203", "010203", "plain", None),  # other non-frame
    ("000000000180", None, "bad_index", None),  # varint cut off
    ("00000000010101", None, "bad_index", None),  # count -1
    ("000000000100", "", "framed", 1),  # empty payload
    ("0000000001060102", None, "bad_index", None),  # count 3, two present
    ("00000000018080808080005A", "5A", "framed", 1),  # six-byte varint for 0
    ("0000000001808080808080005A", None, "bad_index", None),  # seven-byte varint
    ("000000000102FFFFFFFF0F5A", None, "bad_index", None),  # index 2^32-1
    ("000000000102FFFFFFFF075A", "5A", "framed", 1),  # index 2^31-1
    ("00000000018080808010" "5A", None, "bad_index", None),  # count varint 2^32
    ("", None, "empty", None),  # zero-length value
    ("0000000001800077", "77", "framed", 1),  # two-byte encoding of count 0
    ("000000000106010203", "", "framed", 1),  # three one-byte indexes, no payload
    ("FFFFFFFF0100AA", "FFFFFFFF0100AA", "plain", None),
    ("00FFFFFFFF00AA", "AA", "framed", -1),  # schema id read as a signed int
    ("00000000010480808080070180", "80", "framed", 1),  # five-byte index 7 * 2^28, then 1
    ("00000000010405", None, "bad_index", None),  # second index missing
    ("0000000001048080808087000142", "42", "framed", 1),  # fifth byte 0x87 then 0x00
    ("0000000001048080808088000142", None, "bad_index", None),  # fifth byte 0x88
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [(i, None if v is None else bytearray(bytes.fromhex(v))) for i, (v, *_rest) in enumerate(VECTORS)]
    df = spark.createDataFrame(rows, "i int, v binary")
    out = df.select(
        "i", F.hex(strip_framing("v")).alias("stripped"), frame_outcome("v").alias("outcome"), schema_id("v").alias("sid")
    )
    return {r.i: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(VECTORS)))
def test_vector(results, i):
    value, stripped, outcome, sid = VECTORS[i]
    row = results[i]
    assert row.stripped == stripped, value
    assert row.outcome == outcome, value
    assert row.sid == sid, value


def test_varint_helpers():
    assert varint_bytes(0) == b"\x00"
    assert varint_bytes(300) == bytes.fromhex("AC02")
    assert varint_bytes(2**31 - 1) == bytes.fromhex("FFFFFFFF07")
    assert [zigzag(x) for x in (0, -1, 1, -2, 2)] == [0, 1, 2, 3, 4]
    assert message_index_bytes([0]) == b"\x00"
    assert message_index_bytes([1]) == bytes([2, 2])
    assert message_index_bytes([5, 300]) == bytes([4]) + varint_bytes(10) + varint_bytes(600)


def test_frame_roundtrip(spark):
    df = spark.range(0, 300).select(
        F.col("id"),
        F.encode(F.concat(F.lit("m"), F.col("id").cast("string")), "UTF-8").alias("m"),
    )
    framed = df.select(
        "id",
        "m",
        frame("m", 42).alias("a"),
        frame("m", F.col("id") * 1000, (1, 2, 3)).alias("b"),
        frame("m", 7, bytes.fromhex("0405AC02")).alias("c"),
    )
    out = framed.select(
        "id",
        (strip_framing("a") == F.col("m")).alias("a_ok"),
        (strip_framing("b") == F.col("m")).alias("b_ok"),
        (strip_framing("c") == F.col("m")).alias("c_ok"),
        schema_id("a").alias("sa"),
        schema_id("b").alias("sb"),
        F.hex(F.substring("a", 1, 6)).alias("head"),
    ).collect()
    assert all(r.a_ok and r.b_ok and r.c_ok for r in out)
    assert {r.sa for r in out} == {42}
    assert all(r.sb == r.id * 1000 for r in out)
    assert out[0].head == "000000002A00"  # magic, id 42, index byte


def test_sql_function_names(spark):
    names = register_sql_functions(spark, strip_name="strip_confluent")
    assert names["strip"] == "strip_confluent"
    row = spark.sql(
        "SELECT hex(strip_confluent(X'000000007B00010203')) AS s, frame_outcome(X'0A03666F6F') AS o, "
        "frame_schema_id(X'000000007B00010203') AS i"
    ).first()
    assert (row.s, row.o, row.i) == ("010203", "plain", 123)


def test_framing_stays_in_jvm_and_filters_stay_small(spark):
    df = spark.range(10).select(F.unhex(F.lit("000000007B00010203")).alias("value"))
    q = df.select(schema_id("value").alias("sid"), frame_outcome("value").alias("o")).where("sid IS NOT NULL AND o = 'framed'")
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # Pushing the filter down must not copy the index walk many times over.
    assert len(plan) < 20000
    assert q.count() == 10
