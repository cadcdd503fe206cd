"""Topics of several messages, gaps in offsets, and the way back out of the quarantine."""

from __future__ import annotations

import pytest
from google.protobuf import descriptor_pb2
from pyspark.sql import functions as F

from framelake.functions.framing import frame, message_start
from framelake.operators.mixed import framed_message, message_paths
from framelake.operators.quality import offset_gaps
from framelake.schemas import DEMO_EVENT, DEMO_EVENT_BYTES

FILES = {1: "acme/demo/v1/demo.proto", 2: "nested.proto"}


@pytest.fixture(scope="module")
def nested(descriptor_set):
    """The demo files and one whose second message nests another beside a map entry."""
    files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set)
    file = files.file.add(name="nested.proto", package="n")
    file.message_type.add(name="First")
    outer = file.message_type.add(name="Outer")
    outer.nested_type.add(name="TagsEntry").options.map_entry = True
    outer.nested_type.add(name="Inner")
    return files.SerializeToString()


def test_paths_count_map_entries_but_do_not_name_them(nested):
    assert message_paths(nested, "nested.proto") == {"n.First": (0,), "n.Outer": (1,), "n.Outer.Inner": (1, 1)}
    with pytest.raises(ValueError):
        message_paths(nested, "missing.proto")


@pytest.mark.parametrize(
    "schema, indexes, want",
    [
        (1, (0,), DEMO_EVENT),
        (1, bytes.fromhex("0200"), DEMO_EVENT),  # the first message with its count written out
        (1, (1,), DEMO_EVENT_BYTES),
        (2, (1, 1), "n.Outer.Inner"),
        (2, (1, 0), None),  # a map entry
        (2, (7,), None),
        (3, (0,), None),
    ],
)
def test_frames_name_their_message(spark, nested, schema, indexes, want):
    df = spark.sql("SELECT X'0A0161' AS m").select(frame("m", schema, indexes).alias("value")).withColumn("start", message_start("value"))
    assert df.select(framed_message("value", "start", FILES, nested)).first()[0] == want


@pytest.mark.parametrize("value", ["X''", "X'0A0161'", "X'000000000180'", "CAST(NULL AS BINARY)"])
def test_what_is_not_a_frame_names_nothing(spark, nested, value):
    df = spark.sql(f"SELECT {value} AS value").withColumn("start", message_start("value"))
    assert df.select(framed_message("value", "start", FILES, nested)).first()[0] is None


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_gaps_do_not_depend_on_the_ranges(spark, width):
    offsets = {0: [0, 1, 2, 5, 5, 6, 20], 1: [7], 2: [3, 100]}
    rows = [("t", p, o) for p, all_of in offsets.items() for o in all_of] + [("t", 0, None)]
    got = offset_gaps(spark.createDataFrame(rows, "topic string, partition int, offset long"), width).collect()
    assert sorted(tuple(r) for r in got) == [("t", 0, 3, 4, 2), ("t", 0, 7, 19, 13), ("t", 2, 4, 99, 96)]


def test_no_records_no_gaps(spark):
    empty = spark.createDataFrame([], "topic string, partition int, offset long")
    assert offset_gaps(empty.withColumn("missing", F.lit(1))).collect() == []
