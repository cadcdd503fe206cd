"""Record classification, quarantine, frame census and schema-id
reconciliation (DEC-3..DEC-6).

All of it is map-side expressions plus, for the census and reconciliation, one
aggregation with partial (map-side) aggregation, so a hot topic partition or
schema id costs one pre-aggregated row per task, not a skewed shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.functions.framing import (
    OUTCOME_DECODE_ERROR,
    USABLE_OUTCOMES,
    message_start,
    outcome_at,
    schema_id_at,
    strip_at,
)
from framelake.operators.protobuf import PERMISSIVE, from_protobuf

RECORD_ID_COLUMNS = ("topic", "partition", "offset")


def classify(records: DataFrame, message_name: str | None = None, descriptor_set: bytes | None = None, impl: str = "auto") -> DataFrame:
    """Records plus ``outcome``, ``schema_id`` and the stripped ``message``.

    With a message name the stripped bytes are also decoded (PERMISSIVE), a
    usable frame whose message does not parse becomes ``decode_error``, and
    the decoded struct is kept as ``msg``.
    """
    located = records.withColumn("_start", message_start("value"))
    out = located.withColumns(
        {
            "outcome": outcome_at("value", "_start"),
            "schema_id": schema_id_at("value", "_start"),
            "message": strip_at("value", "_start"),
        }
    ).drop("_start")
    if message_name:
        if descriptor_set is None:
            raise ValueError("decoding needs a descriptor set")
        msg = from_protobuf("message", message_name, descriptor_set, mode=PERMISSIVE, impl=impl, once=True)
        out = out.withColumn("msg", msg).withColumn(
            "outcome",
            F.when(F.col("outcome").isin(*USABLE_OUTCOMES) & F.col("msg").isNull(), F.lit(OUTCOME_DECODE_ERROR)).otherwise(
                F.col("outcome")
            ),
        )
    return out


def usable(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome").isin(*USABLE_OUTCOMES))


def quarantined(classified: DataFrame) -> DataFrame:
    """DEC-4: records that carry no usable message, with the raw value and
    the reason."""
    return classified.where(~F.col("outcome").isin(*USABLE_OUTCOMES)).select(
        *RECORD_ID_COLUMNS, "timestamp", "key", "value", "outcome"
    )


def frame_census(classified: DataFrame) -> DataFrame:
    """DEC-5: record count and offset range per topic, partition, schema id
    and outcome."""
    return classified.groupBy("topic", "partition", "schema_id", "outcome").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )


def windowed_census(classified: DataFrame, width: str, delay: str) -> DataFrame:
    """DEC-5 by event time: the census per window of ``width`` of the records'
    timestamps. On a stream a window closes once a timestamp lies ``delay`` past
    its end; its state goes then, and records that come later are left out.
    Records without a timestamp are in no window."""
    timed = classified.withWatermark("timestamp", delay)
    counted = timed.groupBy(F.window("timestamp", width).alias("w"), "topic", "partition", "schema_id", "outcome").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in counted.columns if c != "w"])


def subject_name(topic, message):
    """Subject under the topic-record-name strategy: ``<topic>-<message>``."""
    return F.concat_ws("-", topic, message)


GAP_RANGE = 1 << 20  # offsets of a partition that are looked at together


def offset_gaps(records: DataFrame, width: int = GAP_RANGE) -> DataFrame:
    """DEC-5: the offsets that are missing between a partition's first and last
    record: ``topic, partition, first_missing, last_missing, missing``.

    Offsets are looked at in ranges of ``width``; the gaps at the borders of
    ranges come from their first and last offsets alone, so a partition with a
    third of all records is many tasks. Repeated offsets leave no gap; records
    without an offset are not counted."""
    keys = ["topic", "partition"]
    placed = records.where(F.col("offset").isNotNull()).select(*keys, "offset", F.floor(F.col("offset") / width).alias("range"))
    after = F.lead("offset").over(Window.partitionBy(*keys, "range").orderBy("offset"))
    inner = placed.select(*keys, F.col("offset").alias("before"), after.alias("after"))
    ends = placed.groupBy(*keys, "range").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    border = ends.select(*keys, F.col("last").alias("before"), F.lead("first").over(Window.partitionBy(*keys).orderBy("range")).alias("after"))
    missing = F.col("after") - F.col("before") - 1
    return inner.unionByName(border).where(missing > 0).select(*keys, (F.col("before") + 1).alias("first_missing"), (F.col("after") - 1).alias("last_missing"), missing.alias("missing"))


def registry_table(spark: SparkSession, entries: Iterable[tuple[int, str, str]]) -> DataFrame:
    """Registered schemas as a table: ``schema_id, topic, message, subject``."""
    rows = [
        F.struct(F.lit(int(i)).cast("bigint").alias("schema_id"), F.lit(t).alias("topic"), F.lit(m).alias("message"))
        for i, t, m in entries
    ]
    if not rows:
        raise ValueError("empty registry")
    # A local relation built on the JVM side (no Python worker, no RDD).
    df = spark.range(1).select(F.inline(F.array(*rows)))
    return df.withColumn("subject", subject_name(F.col("topic"), F.col("message")))


def schema_reconcile(classified: DataFrame, registry: DataFrame) -> DataFrame:
    """DEC-6: per topic and schema id seen in framed records, the record count
    and every subject registered for it (one schema id can stand under several
    subjects: a row each); ``registered`` is false for ids the registry does
    not hold for that topic. The seen side is pre-aggregated; the join strategy
    is left to adaptive execution."""
    return with_subjects(seen_ids(classified), registry)


def seen_ids(classified: DataFrame) -> DataFrame:
    """``topic, schema_id, records`` of the framed records."""
    return classified.where(F.col("schema_id").isNotNull()).groupBy("topic", "schema_id").agg(F.count(F.lit(1)).alias("records"))


def with_subjects(seen: DataFrame, registry: DataFrame) -> DataFrame:
    """``seen_ids`` with the subjects that the registry holds for them."""
    subjects = registry.select("topic", "schema_id", "subject", "message").distinct()
    return seen.join(subjects, ["topic", "schema_id"], "left").select(
        "topic",
        "schema_id",
        "records",
        "subject",
        "message",
        F.col("subject").isNotNull().alias("registered"),
    )


def unregistered(report: DataFrame) -> DataFrame:
    return report.where(~F.col("registered"))
