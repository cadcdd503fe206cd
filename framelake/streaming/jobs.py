"""The continuous jobs: ingest (topic -> table), inspect (topic -> console,
one or two named queries) and publish (rows -> framed records)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.functions.framing import USABLE_OUTCOMES, frame
from framelake.functions.headers import cloudevents_headers
from framelake.operators.protobuf import to_protobuf
from framelake.operators.quality import classify, frame_census, seen_ids, windowed_census, with_subjects
from framelake.operators.views import ingest_view, inspect_views
from framelake.session import checkpoint_root
from framelake.settings import Settings
from framelake.sources.topic import read_topic, write_topic
from framelake.streaming.layout import ZonedAppend, ensure_zones
from framelake.streaming.sinks import (
    QuarantineSplitAppend,
    ReplaySafeAppend,
    append_stream,
    complete_stream,
    console_stream,
    ensure_quarantine,
    ensure_target,
    file_stream,
    run_id_for,
)

# Query names and checkpoint suffixes of the dual inspect job,
# and the producer's CloudEvents type prefix and source.
INSPECT_QUERY_NAMES = {"payload": "kafka_consumer_payload", "headers": "kafka_consumer_headers"}
PRODUCER_CE_TYPE_PREFIX = "com."  # before the message's full name
PRODUCER_CE_SOURCE = "urn:acme:producer"


def _checkpoint(spark: SparkSession, settings: Settings, name: str) -> str:
    """The query's checkpoint, a folder of its own for each job under
    ``settings.checkpoint_location``, else under a stable path in the
    configured shared folder derived from topic and table. A restarted job
    resumes where it stopped; jobs that share their settings do not share
    their progress. Without either an error is raised: a path made up per run
    would restart from ``startingOffsets`` and lose or repeat records."""
    base = settings.checkpoint_location
    if not base:
        safe = re.sub(r"[^A-Za-z0-9._-]+", "_", f"{settings.topic}--{settings.table_name}")
        base = f"{checkpoint_root(spark)}/framelake/jobs/{safe}"
    return f"{base.rstrip('/')}/{name}"


def start_ingest(
    spark: SparkSession,
    settings: Settings,
    descriptor_set: bytes,
    trigger: dict | None = None,
    table_location: str | None = None,
    across_runs: bool = False,
    zone_map: bool = False,
) -> StreamingQuery:
    """Topic -> strip -> decode -> (id, payload, ingested_at, lineage) ->
    replay-safe append. The target is created before the query starts. With
    ``across_runs`` a run with a fresh checkpoint does not land a record that
    an earlier run has landed, with ``zone_map`` the target can be compacted
    and read back by its zones (both for parquet targets)."""
    records = read_topic(spark, settings.replace(include_headers=False), streaming=True)
    decoded = ingest_view(
        records, settings.message_name, descriptor_set, mode=settings.decode_mode, impl=settings.protobuf_impl
    )
    table = ensure_target(spark, settings, location=table_location or settings.table_path)
    if zone_map:
        ensure_zones(spark, table)
    append = ZonedAppend if zone_map else ReplaySafeAppend
    return append_stream(decoded, settings, _checkpoint(spark, settings, "ingest"), trigger=trigger, across_runs=across_runs, append=append)


def start_ingest_with_quarantine(
    spark: SparkSession,
    settings: Settings,
    descriptor_set: bytes,
    quarantine_table: str,
    trigger: dict | None = None,
    table_location: str | None = None,
    quarantine_location: str | None = None,
) -> StreamingQuery:
    """Ingest that never stops on a bad record: records are classified (the
    decode is PERMISSIVE), usable ones are appended to the target table and
    the rest, raw bytes and reason, to the quarantine table (DEC-4)."""
    records = read_topic(spark, settings.replace(include_headers=False), streaming=True)
    classified = classify(records, settings.message_name, descriptor_set, impl=settings.protobuf_impl)
    # What the two writes need, and the raw bytes of unusable records only.
    unusable = ~F.col("outcome").isin(*USABLE_OUTCOMES)
    classified = classified.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        "outcome",
        F.col("msg.id").alias("id"),
        F.col("msg.payload").alias("payload"),
        *[F.when(unusable, F.col(c)).alias(c) for c in ("key", "value")],
        F.current_timestamp().alias("ingested_at"),
    )
    table = ensure_target(spark, settings, location=table_location or settings.table_path, batch_partitioned=True)
    quarantine = ensure_quarantine(spark, settings, quarantine_table, location=quarantine_location)
    checkpoint = _checkpoint(spark, settings, "ingest-quarantine")
    writer = classified.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(QuarantineSplitAppend(table, quarantine, run_id_for(spark, checkpoint))).start()


def start_census(
    spark: SparkSession,
    settings: Settings,
    result_path: str,
    descriptor_set: bytes | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Streaming frame census (DEC-5) in complete mode: counts and offset
    range per topic, partition, schema id and outcome, kept up to date at
    ``result_path``. With a descriptor set, decode failures count as
    ``decode_error``."""
    records = read_topic(spark, settings.replace(include_headers=False), streaming=True)
    message = settings.message_name if descriptor_set is not None else None
    census = frame_census(classify(records, message, descriptor_set, impl=settings.protobuf_impl))
    return complete_stream(census, result_path, _checkpoint(spark, settings, "census"), trigger=trigger)


def start_windowed_census(
    spark: SparkSession,
    settings: Settings,
    result_path: str,
    width: str,
    delay: str,
    descriptor_set: bytes | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Streaming census by windows of event time (DEC-5): each window's counts
    are appended to ``result_path`` once, when the watermark closes it. State is
    kept for open windows only."""
    records = read_topic(spark, settings.replace(include_headers=False), streaming=True)
    message = settings.message_name if descriptor_set is not None else None
    census = windowed_census(classify(records, message, descriptor_set, impl=settings.protobuf_impl), width, delay)
    return file_stream(census, result_path, _checkpoint(spark, settings, "census-windows"), trigger=trigger)


def start_reconcile(
    spark: SparkSession, settings: Settings, registry_path: str, result_path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Reconciliation beside the stream (DEC-6): counts by topic and schema id
    are the state, and each micro-batch joins them with the registry table at
    ``registry_path`` as it stands then, so an unregistered id shows in the first
    batch that holds it and clears in the first after its registration.
    ``read_complete`` reads the report."""
    records = read_topic(spark, settings.replace(include_headers=False), streaming=True)
    report = lambda seen: with_subjects(seen, seen.sparkSession.read.parquet(registry_path))
    checkpoint = _checkpoint(spark, settings, "reconcile")
    return complete_stream(seen_ids(classify(records)), result_path, checkpoint, trigger=trigger, finish=report)


def start_inspect(
    spark: SparkSession,
    settings: Settings,
    descriptor_set: bytes | None,
    trigger: dict | None = None,
    sink_paths: dict[str, str] | None = None,
) -> dict[str, StreamingQuery]:
    """Start the inspect view(s) as console queries (or parquet file sinks
    when ``sink_paths`` maps a view to a path). Dual mode starts two named
    queries with checkpoints ``<base>-payload`` and ``<base>-headers``; each
    reads the topic on its own."""
    records = read_topic(spark, settings.replace(include_headers=True), streaming=True)
    views = inspect_views(records, settings, descriptor_set)
    base = _checkpoint(spark, settings, "inspect")
    queries = {}
    for kind, view in views.items():
        checkpoint = f"{base}-{kind}" if settings.dual_stream else base
        name = INSPECT_QUERY_NAMES[kind] if settings.dual_stream else None
        if sink_paths and kind in sink_paths:
            queries[kind] = file_stream(view, sink_paths[kind], checkpoint, query_name=name, trigger=trigger)
        else:
            queries[kind] = console_stream(view, checkpoint, query_name=name, trigger=trigger)
    return queries


def await_queries(
    spark: SparkSession, queries: dict[str, StreamingQuery], poll_seconds: int = 5, finite: bool = False
) -> None:
    """SNK-4: run until any of the queries ends, then stop all of them, and
    re-raise the failure of one that failed. (Polls the given queries rather
    than ``spark.streams.awaitAnyTermination()``, which also returns for
    unrelated queries that ended earlier in the session.) With ``finite``
    (available-now triggers, which end by themselves) every query is awaited
    instead, so a faster one cannot cut a slower one short."""
    active = list(queries.values())
    try:
        if finite:
            for q in active:
                q.awaitTermination()
        else:
            while all(q.isActive for q in active):
                for q in active:
                    if q.awaitTermination(poll_seconds):
                        break
    finally:
        for q in active:
            if q.isActive:
                q.stop()
    for q in active:
        if q.exception() is not None:
            raise q.exception()


def event_records(
    rows: DataFrame,
    message_name: str,
    descriptor_set: bytes,
    schema_id: int,
    id_col: str = "id",
    ce_type: str | None = None,
    ce_source: str = PRODUCER_CE_SOURCE,
    indexes=(0,),
    impl: str = "auto",
) -> DataFrame:
    """SNK-6: rows whose columns are the message's fields -> records with
    ``key`` = id, ``value`` = framed message, four CloudEvents headers. The
    schema id is the one the registry assigned to the message's subject;
    ``ce_type`` follows from the message name unless given."""
    fields = [F.col(c) for c in rows.columns]
    message = to_protobuf(F.struct(*fields), message_name, descriptor_set, impl=impl)
    key = F.col(id_col).cast("string")
    return rows.select(
        key.cast("binary").alias("key"),
        frame(message, schema_id, indexes).alias("value"),
        cloudevents_headers(key, ce_type or PRODUCER_CE_TYPE_PREFIX + message_name, ce_source).alias("headers"),
    )


def publish(rows: DataFrame, settings: Settings, descriptor_set: bytes, schema_id: int, **kwargs) -> None:
    """Publish rows to the topic as framed CloudEvents records (batch)."""
    write_topic(event_records(rows, settings.message_name, descriptor_set, schema_id, **kwargs), settings)


def start_publish(
    rows: DataFrame,
    settings: Settings,
    descriptor_set: bytes,
    schema_id: int,
    trigger: dict | None = None,
    **kwargs,
) -> StreamingQuery:
    """Publish a stream of rows as framed CloudEvents records: Kafka's
    streaming sink, or (parquet topic) each micro-batch as a folder of its own,
    which a replay of the batch replaces."""
    spark, checkpoint = rows.sparkSession, _checkpoint(rows.sparkSession, settings, "publish")
    records = event_records(rows, settings.message_name, descriptor_set, schema_id, **kwargs)
    writer = records.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if settings.topic_format == "kafka":
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", settings.bootstrap_servers)
            .option("topic", settings.topic)
            .start()
        )
    run_id = run_id_for(spark, checkpoint)
    return writer.foreachBatch(lambda batch, batch_id: write_topic(batch, settings, run_id, batch_id)).start()
