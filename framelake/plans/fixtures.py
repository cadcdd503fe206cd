"""Topics derived from the ``events`` table by Spark, so every check grows
with the data: the event topic ``T`` (protobuf messages in every framing
class), ``T_raw`` (the same framing around the raw ``props`` bytes, so SQL can
state the expected bytes) and an envelope topic (nested message and map).

A topic is written once per application into the checkpoint folder, like a
Kafka topic that exists before its consumers run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.framing import frame
from framelake.operators.protobuf import to_protobuf
from framelake.schemas import DEMO_ENVELOPE, DEMO_EVENT, DEMO_EVENT_BYTES, TEST_ROOT, demo_descriptor_set
from framelake.session import scratch_path
from framelake.settings import Settings
from framelake.sources.topic import HEADER_TYPE, RECORD_COLUMNS

# --- Fixed values of the fixture topics -------------------------------------
EVENT_TOPIC = "demo.events"
ENVELOPE_TOPIC = "demo.envelopes"
ROOT_TOPIC = "demo.roots"
FIXTURE_CE_SOURCE = "urn:demo"
TOPIC_PARTITIONS = 4  # partition = event_id % 4, offset = event_id div 4
HEADERLESS_EVERY = 7  # headers are NULL where event_id % 7 = 0
# Value by event_id % 10: (schema id, raw index-array bytes) for frames.
FRAMED_CLASSES = {0: (1, b"\x00"), 8: (8, b"\x00"), 9: (9, b"\x00"), 1: (1, bytes.fromhex("0405AC02"))}
PLAIN_CLASS = 2
BROKEN_VALUES = {3: bytes.fromhex("0000000000"), 4: bytes.fromhex("000000000180"), 5: bytes.fromhex("00000000010101"), 7: b""}
NULL_CLASS = 6
GOOD_CLASSES = (0, 1, 2, 8, 9)
# The hard topic: class 1 has its index count in two bytes, and where
# event_id % 20 = 17 (half of class 7) the value is plain but not protobuf.
HARD_INDEX_BYTES = bytes.fromhex("840005AC02")
HARD_EVERY, HARD_REMAINDER, HARD_VALUE = 20, 17, bytes.fromhex("010203")
ENVELOPE_SCHEMA_ID = 2
ROOT_SCHEMA_ID = 3
# The mixed topic: every third record is an envelope (message 0 of its own
# file), every other third the second message of the event's file, whose id is
# bytes that no string field accepts.
MIXED_TOPIC = "demo.mixed"
MIXED_EVERY, MIXED_ENVELOPE, MIXED_BYTES = 3, 0, 1
BYTES_MARK = bytes.fromhex("FF")
BYTES_SCHEMA_ID = 1
SCHEMA_FILES = {1: "acme/demo/v1/demo.proto", 2: "acme/demo/v1/envelope.proto"}

_materialized: dict[tuple, str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Events in offset order, a topic file per range."""
    return df.repartitionByRange("event_id")


def _record_columns(ev: DataFrame, topic: str, value: Column, headers: Column) -> DataFrame:
    key = F.col("event_id").cast("string")
    return ev.select(
        key.cast("binary").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / TOPIC_PARTITIONS).cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.cast(HEADER_TYPE).alias("headers"),
    ).select(*RECORD_COLUMNS)


def _headers(ev: DataFrame) -> Column:
    key = F.col("event_id").cast("string")
    entries = [("ce_id", key), ("ce_specversion", F.lit("1.0")), ("ce_type", F.col("event_type")), ("ce_source", F.lit(FIXTURE_CE_SOURCE))]
    array = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in entries])
    return F.when(F.pmod(F.col("event_id"), F.lit(HEADERLESS_EVERY)) == 0, F.lit(None)).otherwise(array)


def _framing_classes(message: Column, hard: bool = False) -> Column:
    cls = F.pmod(F.col("event_id"), F.lit(10))
    value = F.when(cls == PLAIN_CLASS, message)
    framed = {**FRAMED_CLASSES, 1: (FRAMED_CLASSES[1][0], HARD_INDEX_BYTES)} if hard else FRAMED_CLASSES
    if hard:
        value = value.when(F.pmod(F.col("event_id"), F.lit(HARD_EVERY)) == HARD_REMAINDER, F.lit(bytearray(HARD_VALUE)))
    for c, (sid, index_bytes) in framed.items():
        value = value.when(cls == c, frame(message, sid, index_bytes))
    for c, raw in BROKEN_VALUES.items():
        value = value.when(cls == c, F.lit(bytearray(raw)))
    return value.otherwise(F.lit(None).cast("binary"))  # NULL_CLASS


def event_message(descriptor_set: bytes) -> Column:
    return to_protobuf(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("created_at_epoch_ms"),
            F.col("props").alias("payload"),
        ),
        DEMO_EVENT,
        descriptor_set,
    )


def event_topic(spark: SparkSession, sf_dir: str, raw: bool = False, hard: bool = False) -> DataFrame:
    """``T`` (or ``T_raw``, or the hard topic) as a lazy DataFrame in the Kafka
    record schema."""
    ev = _spread(events(spark, sf_dir))
    message = F.encode(F.col("props"), "UTF-8") if raw else event_message(demo_descriptor_set())
    return _record_columns(ev, EVENT_TOPIC, _framing_classes(message, hard), _headers(ev))


def envelope_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a framed ``DemoEnvelope`` whose map holds the headers."""
    ev = _spread(events(spark, sf_dir))
    ds = demo_descriptor_set()
    key = F.col("event_id").cast("string")
    header_map = F.when(F.pmod(F.col("event_id"), F.lit(HEADERLESS_EVERY)) == 0, F.lit(None)).otherwise(
        F.create_map(
            F.lit("ce_id"), key,
            F.lit("ce_specversion"), F.lit("1.0"),
            F.lit("ce_type"), F.col("event_type"),
            F.lit("ce_source"), F.lit(FIXTURE_CE_SOURCE),
        )
    )
    event = F.struct(
        key.alias("id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("created_at_epoch_ms"),
        F.col("props").alias("payload"),
    )
    message = to_protobuf(F.struct(event.alias("event"), header_map.alias("headers")), DEMO_ENVELOPE, ds)
    return _record_columns(ev, ENVELOPE_TOPIC, frame(message, ENVELOPE_SCHEMA_ID), F.lit(None))


def root_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a framed ``Root`` (messages from imported files)."""
    ev = _spread(events(spark, sf_dir))
    root = F.struct(
        F.struct(F.col("event_id").cast("string").alias("id")).alias("base"),
        F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")).alias("common"),
    )
    message = to_protobuf(root, TEST_ROOT, demo_descriptor_set())
    return _record_columns(ev, ROOT_TOPIC, frame(message, ROOT_SCHEMA_ID), F.lit(None))


def mixed_topic(spark: SparkSession, sf_dir: str, envelopes: bool = True) -> DataFrame:
    """Frames of three messages in one topic, or of two, without envelopes."""
    ev = _spread(events(spark, sf_dir))
    ds = demo_descriptor_set()
    key, ms = F.col("event_id").cast("string"), F.unix_millis(F.col("ts").cast("timestamp"))
    event = F.struct(key.alias("id"), ms.alias("created_at_epoch_ms"), F.col("props").alias("payload"))
    header_map = F.create_map(F.lit("ce_type"), F.col("event_type"))
    envelope = to_protobuf(F.struct(event.alias("event"), header_map.alias("headers")), DEMO_ENVELOPE, ds)
    marked = F.concat(F.lit(bytearray(BYTES_MARK)), key.cast("binary"))
    raw = to_protobuf(F.struct(marked.alias("id"), ms.alias("created_at_epoch_ms"), F.col("props").alias("payload")), DEMO_EVENT_BYTES, ds)
    kind = F.pmod(F.col("event_id"), F.lit(MIXED_EVERY))
    value = (
        F.when(F.lit(envelopes) & (kind == MIXED_ENVELOPE), frame(envelope, ENVELOPE_SCHEMA_ID))
        .when(kind == MIXED_BYTES, frame(raw, BYTES_SCHEMA_ID, (1,)))
        .otherwise(frame(event_message(ds), 1))
    )
    return _record_columns(ev, MIXED_TOPIC, value, F.lit(None))


_BUILDERS = {
    "events": lambda spark, sf: event_topic(spark, sf),
    "events_raw": lambda spark, sf: event_topic(spark, sf, raw=True),
    "events_hard": lambda spark, sf: event_topic(spark, sf, hard=True),
    "envelopes": envelope_topic,
    "roots": root_topic,
    "mixed": mixed_topic,
    "revised": lambda spark, sf: mixed_topic(spark, sf, envelopes=False),
}
TOPIC_NAMES = {"events": EVENT_TOPIC, "events_raw": EVENT_TOPIC, "events_hard": EVENT_TOPIC, "envelopes": ENVELOPE_TOPIC, "roots": ROOT_TOPIC, "mixed": MIXED_TOPIC, "revised": MIXED_TOPIC}


def topic_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Location of the materialized fixture topic ``kind``."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _materialized:
        path = scratch_path(spark, f"topic-{kind}")
        _BUILDERS[kind](spark, sf_dir).write.mode("errorifexists").parquet(path)
        _materialized[key] = path
    return _materialized[key]


def topic_settings(spark: SparkSession, sf_dir: str, kind: str, **changes) -> Settings:
    """Settings reading fixture topic ``kind`` through the parquet topic
    source, with a parquet target table in the session catalog."""
    base = Settings(
        topic_format="parquet",
        topic=TOPIC_NAMES[kind],
        topic_path=topic_path(spark, sf_dir, kind),
        table_format="parquet",
        catalog="spark_catalog",
        namespace="framelake_demo",
        message_name=DEMO_EVENT,
        protobuf_impl="auto",
    )
    return base.replace(**changes)
