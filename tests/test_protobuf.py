"""Decode/encode through the Arrow path: types, presence rules, modes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions.framing import frame, strip_framing
from framelake.operators.protobuf import PERMISSIVE, from_protobuf, message_class, message_schema, to_protobuf
from framelake.schemas import DEMO_ENVELOPE, DEMO_EVENT, TEST_ROOT, descriptor_set, file_proto


def test_schemas(descriptor_set):
    assert message_schema(descriptor_set, DEMO_EVENT).simpleString() == (
        "struct<id:string,created_at_epoch_ms:bigint,payload:string>"
    )
    assert message_schema(descriptor_set, DEMO_ENVELOPE).simpleString() == (
        "struct<event:struct<id:string,created_at_epoch_ms:bigint,payload:string>,headers:map<string,string>>"
    )
    assert message_schema(descriptor_set, TEST_ROOT).simpleString() == "struct<base:struct<id:string>,common:struct<ts:bigint>>"
    with pytest.raises(ValueError):
        message_schema(descriptor_set, "acme.demo.v1.Missing")


def test_serialized_event_decodes_after_strip(spark, descriptor_set):
    # The serializer's frame: magic, schema id, index byte 0, then the message.
    cls = message_class(descriptor_set, DEMO_EVENT)
    expected = cls(id="id-123", created_at_epoch_ms=1700000000000, payload="hello from test")
    framed = b"\x00" + (1).to_bytes(4, "big") + b"\x00" + expected.SerializeToString()
    df = spark.createDataFrame([(bytearray(framed),), (bytearray(expected.SerializeToString()),)], "value binary")
    rows = df.select(from_protobuf(strip_framing("value"), DEMO_EVENT, descriptor_set).alias("m")).collect()
    for row in rows:  # framed and plain give the same event
        assert row.m.asDict() == {"id": "id-123", "created_at_epoch_ms": 1700000000000, "payload": "hello from test"}


def test_presence_and_modes(spark, descriptor_set):
    cls = message_class(descriptor_set, DEMO_EVENT)
    values = [
        cls(id="a", created_at_epoch_ms=0, payload="").SerializeToString(),  # zero values are absent
        b"",  # empty message: every field absent, struct present
        None,
        bytes.fromhex("010203"),  # field number 0: not a message
    ]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    out = {r.i: r.m for r in df.select("i", from_protobuf("v", DEMO_EVENT, descriptor_set, mode=PERMISSIVE).alias("m")).collect()}
    assert out[0].asDict() == {"id": "a", "created_at_epoch_ms": None, "payload": None}
    assert out[1].asDict() == {"id": None, "created_at_epoch_ms": None, "payload": None}
    assert out[2] is None
    assert out[3] is None
    with pytest.raises(Exception, match="MALFORMED_PROTOBUF_MESSAGE"):
        df.select(from_protobuf("v", DEMO_EVENT, descriptor_set).alias("m")).collect()


def test_nested_map_and_imports_roundtrip(spark, descriptor_set):
    df = spark.range(5).select(
        F.struct(
            F.struct(F.col("id").cast("string").alias("id"), (F.col("id") + 1).alias("created_at_epoch_ms"), F.lit(None).cast("string").alias("payload")).alias("event"),
            F.when(F.col("id") == 0, F.lit(None)).otherwise(F.create_map(F.lit("k"), F.col("id").cast("string"))).alias("headers"),
        ).alias("env"),
        F.struct(F.struct(F.col("id").cast("string").alias("id")).alias("base"), F.struct((F.col("id") * 10).alias("ts")).alias("common")).alias("root"),
    )
    back = df.select(
        "env",
        from_protobuf(to_protobuf("env", DEMO_ENVELOPE, descriptor_set), DEMO_ENVELOPE, descriptor_set).alias("env2"),
        "root",
        from_protobuf(to_protobuf("root", TEST_ROOT, descriptor_set), TEST_ROOT, descriptor_set).alias("root2"),
    ).collect()
    for r in back:
        assert r.env2.event.asDict() == r.env.event.asDict()
        assert r.env2.headers == (r.env.headers or {})  # an empty or NULL map comes back empty, as from the connector
        assert r.root2.asDict(recursive=True) == r.root.asDict(recursive=True) or r.root.base.id == "0"


def test_all_scalar_kinds(spark):
    files = [
        file_proto(
            "t/kinds.proto",
            "t",
            [
                (
                    "Kinds",
                    [
                        ("d", 1, "double"), ("f", 2, "float"), ("i32", 3, "int32"), ("i64", 4, "int64"),
                        ("u32", 5, "uint32"), ("u64", 6, "uint64"), ("s32", 7, "sint32"), ("s64", 8, "sint64"),
                        ("b", 9, "bool"), ("s", 10, "string"), ("by", 11, "bytes"), ("rep", 12, "repeated int32"),
                        ("ts", 13, "google.protobuf.Timestamp"), ("m", 14, "map<string,int64>"),
                    ],
                )
            ],
            dependencies=["google/protobuf/timestamp.proto"],
        )
    ]
    ds = descriptor_set(files)
    schema = message_schema(ds, "t.Kinds")
    assert [f.dataType for f in schema.fields][:11] == [
        T.DoubleType(), T.FloatType(), T.IntegerType(), T.LongType(), T.IntegerType(), T.LongType(),
        T.IntegerType(), T.LongType(), T.BooleanType(), T.StringType(), T.BinaryType(),
    ]
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    row = F.struct(
        F.lit(1.5).alias("d"), F.lit(2.5).cast("float").alias("f"), F.lit(-3).alias("i32"), F.lit(-4).cast("long").alias("i64"),
        F.lit(-1).alias("u32"), F.lit(6).cast("long").alias("u64"), F.lit(-7).alias("s32"), F.lit(-8).cast("long").alias("s64"),
        F.lit(True).alias("b"), F.lit("x").alias("s"), F.lit(bytearray(b"\x01\x02")).alias("by"),
        F.array(F.lit(1), F.lit(2)).alias("rep"), F.lit(when).alias("ts"), F.create_map(F.lit("a"), F.lit(9).cast("long")).alias("m"),
    )
    out = spark.range(1).select(from_protobuf(to_protobuf(row, "t.Kinds", ds), "t.Kinds", ds).alias("k")).first().k
    assert (out.d, out.f, out.i32, out.i64, out.u32, out.u64, out.s32, out.s64) == (1.5, 2.5, -3, -4, -1, 6, -7, -8)
    assert (out.b, out.s, bytes(out.by), out.rep, out.m) == (True, "x", b"\x01\x02", [1, 2], {"a": 9})
    assert out.ts == when


def test_framed_publish_then_strip(spark, descriptor_set):
    df = spark.range(3).select(F.struct(F.col("id").cast("string").alias("id")).alias("e"))
    framed = df.select(frame(to_protobuf("e", DEMO_EVENT, descriptor_set), 5, (0,)).alias("v"))
    ids = [r.m.id for r in framed.select(from_protobuf(strip_framing("v"), DEMO_EVENT, descriptor_set).alias("m")).collect()]
    assert sorted(ids) == ["0", "1", "2"]


def test_proto2_default_of_an_absent_field(spark):
    """The connector gives an absent proto2 field its default, and NULL if it has none."""
    from google.protobuf import descriptor_pb2

    file = descriptor_pb2.FileDescriptorProto(name="t/two.proto", package="t", syntax="proto2")
    message = file.message_type.add(name="Two")
    kinds = descriptor_pb2.FieldDescriptorProto
    message.field.add(name="a", number=1, type=kinds.TYPE_INT32, label=kinds.LABEL_OPTIONAL, default_value="7")
    message.field.add(name="b", number=2, type=kinds.TYPE_INT32, label=kinds.LABEL_OPTIONAL)
    descriptors = descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()
    df = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\x08\x00\x10\x05"),)], "v binary")
    out = [r.m.asDict() for r in df.select(from_protobuf("v", "t.Two", descriptors).alias("m")).collect()]
    assert out == [{"a": 7, "b": None}, {"a": 0, "b": 5}]
