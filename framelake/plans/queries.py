"""The registered checks: one Spark query per operator over topics derived
from ``events``, each with the DuckDB SQL that states the expected rows.

Column names match between a query and its SQL. Queries that run streams do
so with ``trigger(availableNow=True)`` into fresh locations under the
checkpoint folder and return the resulting table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.framing import register_sql_functions
from framelake.functions.headers import cloudevents_columns
from framelake.operators.mixed import decode_mixed
from framelake.operators.protobuf import PERMISSIVE
from framelake.operators.quality import classify, frame_census, offset_gaps, quarantined, registry_table, schema_reconcile
from framelake.operators.readback import read_table, sample_rows
from framelake.operators.views import decoded_message, headers_view, ingest_view, payload_view, raw_view, record_view
from framelake.plans.fixtures import EVENT_TOPIC, MIXED_TOPIC, SCHEMA_FILES, topic_settings
from framelake.schemas import DEMO_ENVELOPE, DEMO_EVENT, DEMO_EVENT_BYTES, TEST_ROOT, demo_descriptor_set
from framelake.session import scratch_path
from framelake.sources.descriptors import load_descriptor_set, save_descriptor_set
from framelake.sources.topic import read_topic, write_topic
from framelake.streaming.jobs import (
    INSPECT_QUERY_NAMES,
    event_records,
    start_census,
    start_ingest,
    start_ingest_with_quarantine,
    start_inspect,
    start_reconcile,
    start_windowed_census,
)
from framelake.streaming.layout import ZonedAppend, compact, ensure_zones, latest_target_rows, live_partitions, read_target
from framelake.streaming.sinks import RECOVERED, ReplaySafeAppend, ensure_target, read_complete, read_quarantine, recover, run_id_for

RECORD_KEYS = ["topic", "partition", "offset"]
TARGET_VIEW = ["id", "payload", "topic", "partition", "offset"]
# The registry the reconciliation check uses (id 9 is absent, two
# messages of one file share id 1).
REGISTERED = [(1, EVENT_TOPIC, DEMO_EVENT), (1, EVENT_TOPIC, DEMO_ENVELOPE), (8, EVENT_TOPIC, DEMO_ENVELOPE)]
LATE_REGISTERED = (9, EVENT_TOPIC, DEMO_EVENT)  # registered while reconcile_stream runs
PUBLISH_SCHEMA_ID = 1

_ingested: dict[tuple, str] = {}
_split: dict[tuple, tuple[str, str]] = {}


def _topic(spark: SparkSession, sf_dir: str, kind: str = "events") -> DataFrame:
    return read_topic(spark, topic_settings(spark, sf_dir, kind), streaming=False)


def decoded_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-1 + DEC-2 + PRJ-3/PRJ-5: the inspect job's decoded view."""
    return payload_view(record_view(_topic(spark, sf_dir)), DEMO_EVENT, demo_descriptor_set())


def strip_framing_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-1 through the SQL function (UDF-1), over the raw-bytes topic."""
    names = register_sql_functions(spark)
    return _topic(spark, sf_dir, "events_raw").selectExpr(
        *RECORD_KEYS,
        f"{names['outcome']}(value) AS outcome",
        f"hex({names['strip']}(value)) AS message_hex",
    )


def raw_hex_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-7 + FN-1: the view used when no message name is set."""
    return raw_view(record_view(_topic(spark, sf_dir, "events_raw")))


def header_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6 + FN-2..FN-5 + PRJ-4."""
    return headers_view(record_view(_topic(spark, sf_dir)))


def schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-3 with the framing outcome."""
    return classify(_topic(spark, sf_dir)).select(*RECORD_KEYS, "outcome", "schema_id")


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-2 on a nested message with a map field."""
    base = record_view(_topic(spark, sf_dir, "envelopes"))
    env = payload_view(base, DEMO_ENVELOPE, demo_descriptor_set(), fields=None)
    return env.select(
        *RECORD_KEYS,
        F.col("event.id").alias("id"),
        F.col("event.created_at_epoch_ms").alias("created_at_epoch_ms"),
        F.col("event.payload").alias("payload"),
        F.col("headers").getItem("ce_type").alias("ce_type"),
        F.col("headers").getItem("ce_source").alias("ce_source"),
    )


def imported_types_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-2 on a message whose fields come from two imported files."""
    base = record_view(_topic(spark, sf_dir, "roots"))
    root = payload_view(base, TEST_ROOT, demo_descriptor_set(), fields=None)
    return root.select(*RECORD_KEYS, F.col("base.id").alias("id"), F.col("common.ts").alias("ts"))


def decoded_payload_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5 under a predicate on record columns, which reaches the scan: only
    the records it keeps are decoded."""
    return decoded_payload(spark, sf_dir).where("partition = 1 AND timestamp >= TIMESTAMP '2024-01-15 00:00:00'")


def _published(spark: SparkSession, sf_dir: str, replay: bool) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("created_at_epoch_ms"),
        F.col("props").alias("payload"),
    )
    settings = topic_settings(spark, sf_dir, "events").replace(
        topic="demo.published", topic_path=scratch_path(spark, "topic-published")
    )
    ds = demo_descriptor_set()
    for _ in range(2 if replay else 1):
        write_topic(event_records(rows, DEMO_EVENT, ds, PUBLISH_SCHEMA_ID), settings, run_id="run", batch_id=0)
    base = record_view(read_topic(spark, settings, streaming=False))
    msg = decoded_message("value", DEMO_EVENT, ds)
    return base.select(msg.alias("msg"), *cloudevents_columns("headers")).select(
        "msg.id", "msg.created_at_epoch_ms", "msg.payload", "ce_id", "ce_specversion", "ce_type", "ce_source"
    )


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6: publish events as framed CloudEvents records, read them back."""
    return _published(spark, sf_dir, replay=False)


def publish_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 replay: one batch of a run published twice lands once."""
    return _published(spark, sf_dir, replay=True)


def _ingest_table(spark: SparkSession, sf_dir: str, fresh: bool = False) -> str:
    """Run the ingest stream over the event topic into a new parquet table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if fresh or key not in _ingested:
        suffix = scratch_path(spark, "t").rsplit("-", 1)[-1]
        settings = topic_settings(spark, sf_dir, "events").replace(
            table=f"demo_events_{suffix}", checkpoint_location=scratch_path(spark, "checkpoint-ingest")
        )
        query = start_ingest(
            spark,
            settings,
            demo_descriptor_set(),
            trigger={"availableNow": True},
            table_location=scratch_path(spark, "table-demo-events"),
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        _ingested[key] = settings.table_name
    return _ingested[key]


def ingest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1/2 (file topic) + SNK-1/2/5: streaming ingest into a table."""
    return read_table(spark, _ingest_table(spark, sf_dir, fresh=True)).select(*TARGET_VIEW)


def ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 replay: the same micro-batch written twice lands once."""
    settings = topic_settings(spark, sf_dir, "events")
    suffix = scratch_path(spark, "t").rsplit("-", 1)[-1]
    settings = settings.replace(table=f"demo_replay_{suffix}")
    table = ensure_target(spark, settings, location=scratch_path(spark, "table-replay"))
    writer = ReplaySafeAppend(table, run_id_for(spark, scratch_path(spark, "checkpoint-replay")))
    batch = ingest_view(read_topic(spark, settings, streaming=False), DEMO_EVENT, demo_descriptor_set())
    writer(batch, 0)
    writer(batch, 0)  # the replay after a failure before the offset commit
    return read_table(spark, table).select(*TARGET_VIEW)


def dual_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: the rows of the two named inspect queries."""
    settings = topic_settings(spark, sf_dir, "events", dual_stream=True, checkpoint_location=scratch_path(spark, "checkpoint-inspect"))
    paths = {kind: scratch_path(spark, f"inspect-{kind}") for kind in INSPECT_QUERY_NAMES}
    queries = start_inspect(spark, settings, demo_descriptor_set(), trigger={"availableNow": True}, sink_paths=paths)
    for q in queries.values():
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    rows = [
        spark.read.parquet(paths[kind]).select(F.lit(queries[kind].name).alias("query_name"), *RECORD_KEYS, "key", F.col(value).alias("value"))
        for kind, value in (("payload", "payload"), ("headers", "ce_type"))
    ]
    return rows[0].unionByName(rows[1])


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1 + SRC-3: newest rows of a table of three batches, the two newest
    of which are small."""
    settings = topic_settings(spark, sf_dir, "events").replace(table=f"demo_latest_{scratch_path(spark, 't').rsplit('-', 1)[-1]}")
    table = ensure_target(spark, settings, location=scratch_path(spark, "table-latest"))
    ensure_zones(spark, table)
    writer = ZonedAppend(table, run_id_for(spark, scratch_path(spark, "checkpoint-latest")))
    rows = ingest_view(read_topic(spark, settings, streaming=False), DEMO_EVENT, demo_descriptor_set())
    kind = (F.col("offset") * 4 + F.col("partition")) % 100
    for batch_id, (hour, keep) in enumerate(((1, kind > 1), (3, kind == 0), (2, kind == 1))):
        writer(rows.where(keep).withColumn("ingested_at", F.expr(f"TIMESTAMP '2024-02-01 0{hour}:00:00'")), batch_id)
    return latest_target_rows(spark, table).select(*TARGET_VIEW)


def ingest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/SNK-2 layout: five batches of two days, packed by day; afterwards
    the newest batch and a packed one are replayed."""
    settings = topic_settings(spark, sf_dir, "events").replace(table=f"demo_compacted_{scratch_path(spark, 't').rsplit('-', 1)[-1]}")
    table = ensure_target(spark, settings, location=scratch_path(spark, "table-compacted"))
    ensure_zones(spark, table)
    writer = ZonedAppend(table, run_id_for(spark, scratch_path(spark, "checkpoint-compacted")))
    rows = ingest_view(read_topic(spark, settings, streaming=False), DEMO_EVENT, demo_descriptor_set())
    parts = [rows.where(F.col("offset") % 5 == i).withColumn("ingested_at", F.expr(f"TIMESTAMP '2024-02-0{1 + i // 2} 0{i}:00:00'")) for i in range(5)]
    for batch_id, batch in enumerate(parts):
        writer(batch, batch_id)
    compact(spark, table)
    for batch_id in (4, 0):
        writer(parts[batch_id], batch_id)
    left = live_partitions(spark, table).agg(F.count(F.lit(1)).alias("partitions"))
    return read_target(spark, table).select(*TARGET_VIEW, "run_id").withColumn("packed", F.col("run_id").startswith("packed_")).drop("run_id").join(F.broadcast(left))


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-2: ten rows of the ingested table, in no particular order; counted,
    since which ten is not determined."""
    table = read_table(spark, _ingest_table(spark, sf_dir))
    sampled = sample_rows(table.select(*RECORD_KEYS))
    known = table.select(*RECORD_KEYS).withColumn("known", F.lit(1))
    return sampled.join(known, RECORD_KEYS, "left").agg(
        F.count(F.lit(1)).alias("sampled"), F.countDistinct(*RECORD_KEYS).alias("distinct_rows"), F.count("known").alias("in_table")
    )


def ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-6: ``ingested_at`` is set in every row and constant in a batch."""
    per_batch = read_table(spark, _ingest_table(spark, sf_dir)).groupBy("run_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("ingested_at").alias("set"), F.countDistinct("ingested_at").alias("times")
    )
    return per_batch.agg(F.sum("n").alias("records"), F.sum(F.col("n") - F.col("set")).alias("nulls"), F.max("times").alias("times_per_batch"))


def _split_ingest(spark: SparkSession, sf_dir: str, fresh: bool = False) -> tuple[str, str]:
    """Run the ingest-with-quarantine stream (again when ``fresh``); the
    latest run is kept for the quarantine side."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if fresh or key not in _split:
        suffix = scratch_path(spark, "t").rsplit("-", 1)[-1]
        settings = topic_settings(spark, sf_dir, "events_hard").replace(
            table=f"demo_usable_{suffix}", checkpoint_location=scratch_path(spark, "checkpoint-split")
        )
        query = start_ingest_with_quarantine(
            spark,
            settings,
            demo_descriptor_set(),
            quarantine_table=f"demo_quarantine_{suffix}",
            trigger={"availableNow": True},
            table_location=scratch_path(spark, "table-usable"),
            quarantine_location=scratch_path(spark, "table-quarantine"),
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        _split[key] = (settings.table_name, f"{settings.catalog}.{settings.namespace}.demo_quarantine_{suffix}")
    return _split[key]


def ingest_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-4 in the stream: the usable side of the split ingest."""
    return read_table(spark, _split_ingest(spark, sf_dir, fresh=True)[0]).select(*TARGET_VIEW)


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-4 in the stream: the quarantined side, raw bytes and reason."""
    q = read_table(spark, _split_ingest(spark, sf_dir)[1])
    return q.select(*RECORD_KEYS, F.col("key").cast("string").alias("key"), F.hex("value").alias("value_hex"), "outcome")


def _run_census(spark: SparkSession, settings) -> DataFrame:
    path = scratch_path(spark, "census")
    query = start_census(spark, settings, path, demo_descriptor_set(), trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return read_complete(spark, path)


def census_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-5 as a streaming aggregate in complete mode."""
    return _run_census(spark, topic_settings(spark, sf_dir, "events_hard", checkpoint_location=scratch_path(spark, "checkpoint-census")))


def census_beside_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: the ingest and then the census from one and the same settings;
    neither takes the other's progress for its own."""
    suffix = scratch_path(spark, "t").rsplit("-", 1)[-1]
    settings = topic_settings(spark, sf_dir, "events").replace(table=f"demo_beside_{suffix}", checkpoint_location=scratch_path(spark, "checkpoint-shared"))
    query = start_ingest(spark, settings, demo_descriptor_set(), trigger={"availableNow": True}, table_location=scratch_path(spark, "table-beside"))
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return _run_census(spark, settings)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-4: records with no usable message, with the reason."""
    q = quarantined(classify(_topic(spark, sf_dir, "events_hard"), DEMO_EVENT, demo_descriptor_set()))
    return q.select(*RECORD_KEYS, F.col("key").cast("string").alias("key"), F.hex("value").alias("value_hex"), "outcome")


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-5."""
    return frame_census(classify(_topic(spark, sf_dir, "events_hard"), DEMO_EVENT, demo_descriptor_set()))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-6."""
    return schema_reconcile(classify(_topic(spark, sf_dir)), registry_table(spark, REGISTERED))


def descriptor_file_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: the decoded view with a descriptor set read from a file."""
    path = scratch_path(spark, "descriptors") + "/demo.desc"
    save_descriptor_set(spark, path, demo_descriptor_set())
    return payload_view(record_view(_topic(spark, sf_dir)), DEMO_EVENT, load_descriptor_set(spark, path))


def _unmarked(id_bytes: Column) -> Column:
    """The text of an id in bytes, which has a mark of one byte before it."""
    return F.decode(F.substring(id_bytes, F.lit(2), F.length(id_bytes)), "UTF-8")


def mixed_topic_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-1 + DEC-2 by message indexes: three messages in one topic."""
    decoded = decode_mixed(_topic(spark, sf_dir, "mixed"), SCHEMA_FILES, demo_descriptor_set())
    field = lambda path, kind: F.try_variant_get("body", path, kind)
    event = F.when(F.col("message") == DEMO_ENVELOPE, F.lit("$.event.")).otherwise(F.lit("$."))
    return decoded.select(
        *RECORD_KEYS,
        "message",
        F.when(F.col("message") == DEMO_EVENT_BYTES, _unmarked(field("$.id", "binary"))).otherwise(field(F.concat(event, F.lit("id")), "string")).alias("id"),
        field(F.concat(event, F.lit("created_at_epoch_ms")), "long").alias("created_at_epoch_ms"),
        field(F.concat(event, F.lit("payload")), "string").alias("payload"),
        field("$.headers.ce_type", "string").alias("ce_type"),
    )


def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 across runs: the same records through two checkpoints land once."""
    settings = topic_settings(spark, sf_dir, "events").replace(table=f"demo_rerun_{scratch_path(spark, 't').rsplit('-', 1)[-1]}")
    location = scratch_path(spark, "table-rerun")
    for _ in range(2):
        run = settings.replace(checkpoint_location=scratch_path(spark, "checkpoint-rerun"))
        query = start_ingest(spark, run, demo_descriptor_set(), trigger={"availableNow": True}, table_location=location, across_runs=True)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return read_table(spark, settings.table_name).select(*TARGET_VIEW)


def quarantine_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-4, the way back: records of a revised message, quarantined at first,
    are recovered with its schema, twice over; ``open`` counts what is left."""
    suffix = scratch_path(spark, "t").rsplit("-", 1)[-1]
    settings = topic_settings(spark, sf_dir, "revised").replace(table=f"demo_recovered_{suffix}", checkpoint_location=scratch_path(spark, "checkpoint-recovered"))
    ds, quarantine_table = demo_descriptor_set(), f"{settings.catalog}.{settings.namespace}.demo_unrecovered_{suffix}"
    query = start_ingest_with_quarantine(
        spark, settings, ds, quarantine_table=f"demo_unrecovered_{suffix}", trigger={"availableNow": True},
        table_location=scratch_path(spark, "table-recovered"), quarantine_location=scratch_path(spark, "table-unrecovered"),
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    msg = decoded_message("value", DEMO_EVENT_BYTES, ds, mode=PERMISSIVE)
    for _ in range(2):
        decoded = read_quarantine(spark, quarantine_table).select(msg.alias("msg"), *RECORD_KEYS)
        decoded = decoded.select(_unmarked(F.col("msg.id")).alias("id"), F.col("msg.payload").alias("payload"), F.current_timestamp().alias("ingested_at"), *RECORD_KEYS)
        recover(decoded, settings.table_name, "revised")
    left = read_quarantine(spark, quarantine_table, settings.table_name).agg(F.count(F.lit(1)).alias("open"))
    rows = read_table(spark, settings.table_name).select(*TARGET_VIEW, F.col("run_id").startswith(RECOVERED).alias("recovered"))
    return rows.join(F.broadcast(left))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-5: missing offsets of a topic with holes, one of them wide."""
    number = F.col("offset") * 4 + F.col("partition")
    holes = (number % 13).isin(2, 6) | (F.col("offset").between(100, 120) & (F.col("partition") == 3))
    return offset_gaps(_topic(spark, sf_dir).where(~holes), width=64)


def _finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def census_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-5 by event time: the days that the watermark has closed."""
    settings, path = topic_settings(spark, sf_dir, "events_hard", checkpoint_location=scratch_path(spark, "checkpoint-windows")), scratch_path(spark, "census-windows")
    _finished(start_windowed_census(spark, settings, path, "1 day", "6 hours", demo_descriptor_set(), trigger={"availableNow": True}))
    return spark.read.parquet(path)


def reconcile_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEC-6 on the stream: the report after each half of the topic; an id that
    the first half shows to be missing is registered in between."""
    path, registry = scratch_path(spark, "topic-halves"), scratch_path(spark, "registry")
    result = scratch_path(spark, "reconcile")
    settings = topic_settings(spark, sf_dir, "events", checkpoint_location=scratch_path(spark, "checkpoint-reconcile")).replace(topic_path=path)
    registered, reports = REGISTERED, []
    for half in (0, 1):
        _topic(spark, sf_dir).where(F.col("offset") % 2 == half).write.parquet(f"{path}/half-{half}")
        registry_table(spark, registered).write.mode("overwrite").parquet(registry)
        _finished(start_reconcile(spark, settings, registry, result, trigger={"availableNow": True}))
        reports.append(read_complete(spark, result).withColumn("half", F.lit(half)))
        registered = [*registered, LATE_REGISTERED]
    return reports[0].unionByName(reports[1])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decoded_payload": decoded_payload,
    "decoded_payload_filtered": decoded_payload_filtered,
    "strip_framing": strip_framing_sql,
    "raw_hex_view": raw_hex_view,
    "header_view": header_view,
    "schema_ids": schema_ids,
    "envelope_decode": envelope_decode,
    "imported_types_decode": imported_types_decode,
    "publish_roundtrip": publish_roundtrip,
    "publish_replay": publish_replay,
    "ingest_append": ingest_append,
    "ingest_replay": ingest_replay,
    "dual_stream": dual_stream,
    "latest_rows": latest,
    "sample_rows": sample,
    "ingested_at": ingested_at,
    "quarantine": quarantine,
    "ingest_usable": ingest_usable,
    "ingest_quarantine": ingest_quarantine,
    "frame_census": census,
    "census_stream": census_stream,
    "census_beside_ingest": census_beside_ingest,
    "schema_reconcile": reconcile,
    "descriptor_file_decode": descriptor_file_decode,
    "mixed_topic_decode": mixed_topic_decode,
    "ingest_rerun": ingest_rerun,
    "quarantine_recovered": quarantine_recovered,
    "offset_gaps": gaps,
    "ingest_compacted": ingest_compacted,
    "census_windows": census_windows,
    "reconcile_stream": reconcile_stream,
}

# --- DuckDB statements of the expected rows ------------------------------------
_KEYS = f"""'{EVENT_TOPIC}' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset\""""
_GOOD = "event_id % 10 IN (0, 1, 2, 8, 9)"
_OUTCOME = """CASE event_id % 10 WHEN 0 THEN 'framed' WHEN 1 THEN 'framed' WHEN 8 THEN 'framed'
  WHEN 9 THEN 'framed' WHEN 2 THEN 'plain' WHEN 3 THEN 'too_short' WHEN 4 THEN 'bad_index'
  WHEN 5 THEN 'bad_index' WHEN 6 THEN 'null_value' ELSE 'empty' END"""
# The hard topic, decoded: where event_id % 20 = 17 the value is 010203.
_HARD_OUTCOME = f"CASE WHEN event_id % 20 = 17 THEN 'decode_error' ELSE {_OUTCOME} END"
_SCHEMA_ID = "CAST(CASE event_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 8 THEN 8 WHEN 9 THEN 9 END AS BIGINT)"
_MS = "epoch_us(ts) // 1000"
_HDR = "event_id % 7 = 0"

ORACLE_SQL: dict[str, str] = {
    "decoded_payload": f"""SELECT {_KEYS}, ts AS "timestamp", CAST(event_id AS VARCHAR) AS "key",
  CASE WHEN {_GOOD} THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN {_GOOD} THEN props END AS payload
FROM events""",
    "strip_framing": f"""SELECT {_KEYS}, {_OUTCOME} AS outcome,
  CASE WHEN {_GOOD} THEN hex(props) END AS message_hex
FROM events""",
    "raw_hex_view": f"""SELECT {_KEYS}, ts AS "timestamp", CAST(event_id AS VARCHAR) AS "key",
  CASE event_id % 10
    WHEN 0 THEN '0000000001' || '00' || hex(props)
    WHEN 8 THEN '0000000008' || '00' || hex(props)
    WHEN 9 THEN '0000000009' || '00' || hex(props)
    WHEN 1 THEN '0000000001' || '0405AC02' || hex(props)
    WHEN 2 THEN hex(props)
    WHEN 3 THEN '0000000000'
    WHEN 4 THEN '000000000180'
    WHEN 5 THEN '00000000010101'
    WHEN 6 THEN NULL
    ELSE '' END AS value_hex
FROM events""",
    "header_view": f"""SELECT {_KEYS}, ts AS "timestamp", CAST(event_id AS VARCHAR) AS "key",
  CASE WHEN {_HDR} THEN NULL ELSE CAST(event_id AS VARCHAR) END AS ce_id,
  CASE WHEN {_HDR} THEN NULL ELSE '1.0' END AS ce_specversion,
  CASE WHEN {_HDR} THEN NULL ELSE event_type END AS ce_type,
  CASE WHEN {_HDR} THEN NULL ELSE 'urn:demo' END AS ce_source
FROM events""",
    "schema_ids": f"""SELECT {_KEYS}, {_OUTCOME} AS outcome, {_SCHEMA_ID} AS schema_id FROM events""",
    "envelope_decode": f"""SELECT 'demo.envelopes' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
  CAST(event_id AS VARCHAR) AS id, {_MS} AS created_at_epoch_ms, props AS payload,
  CASE WHEN {_HDR} THEN NULL ELSE event_type END AS ce_type,
  CASE WHEN {_HDR} THEN NULL ELSE 'urn:demo' END AS ce_source
FROM events""",
    "imported_types_decode": f"""SELECT 'demo.roots' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
  CAST(event_id AS VARCHAR) AS id, {_MS} AS ts
FROM events""",
    "publish_roundtrip": f"""SELECT CAST(event_id AS VARCHAR) AS id, {_MS} AS created_at_epoch_ms, props AS payload,
  CAST(event_id AS VARCHAR) AS ce_id, '1.0' AS ce_specversion,
  'com.acme.demo.v1.DemoEvent' AS ce_type, 'urn:acme:producer' AS ce_source
FROM events""",
    "ingest_append": f"""SELECT CASE WHEN {_GOOD} THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN {_GOOD} THEN props END AS payload, {_KEYS}
FROM events""",
    "ingest_replay": f"""SELECT CASE WHEN {_GOOD} THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN {_GOOD} THEN props END AS payload, {_KEYS}
FROM events""",
    "dual_stream": f"""SELECT 'kafka_consumer_payload' AS query_name, {_KEYS}, CAST(event_id AS VARCHAR) AS "key",
  CASE WHEN {_GOOD} THEN props END AS "value" FROM events
UNION ALL
SELECT 'kafka_consumer_headers' AS query_name, {_KEYS}, CAST(event_id AS VARCHAR) AS "key",
  CASE WHEN NOT ({_HDR}) THEN event_type END AS "value" FROM events""",
    "sample_rows": "SELECT least(10, count(*)) AS sampled, least(10, count(*)) AS distinct_rows, least(10, count(*)) AS in_table FROM events",
    "ingested_at": "SELECT count(*) AS records, 0::BIGINT AS nulls, 1::BIGINT AS times_per_batch FROM events",
    "latest_rows": f"""SELECT CASE WHEN {_GOOD} THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN {_GOOD} THEN props END AS payload, {_KEYS}
FROM events ORDER BY CASE event_id % 100 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END DESC, event_id // 4 DESC, event_id % 4 DESC LIMIT 50""",
    "quarantine": f"""SELECT {_KEYS}, CAST(event_id AS VARCHAR) AS "key",
  CASE event_id % 10 WHEN 3 THEN '0000000000' WHEN 4 THEN '000000000180'
    WHEN 5 THEN '00000000010101' WHEN 6 THEN NULL ELSE CASE WHEN event_id % 20 = 17 THEN '010203' ELSE '' END END AS value_hex,
  {_HARD_OUTCOME} AS outcome
FROM events WHERE NOT ({_GOOD})""",
    "ingest_usable": f"""SELECT CAST(event_id AS VARCHAR) AS id, props AS payload, {_KEYS}
FROM events WHERE {_GOOD}""",
    "frame_census": f"""WITH t AS (SELECT {_KEYS}, {_SCHEMA_ID} AS schema_id, {_HARD_OUTCOME} AS outcome FROM events)
SELECT topic, "partition", schema_id, outcome, count(*) AS records,
  min("offset") AS min_offset, max("offset") AS max_offset
FROM t GROUP BY topic, "partition", schema_id, outcome""",
    "schema_reconcile": f"""WITH seen AS (
  SELECT '{EVENT_TOPIC}' AS topic, {_SCHEMA_ID} AS schema_id, count(*) AS records
  FROM events WHERE event_id % 10 IN (0, 1, 8, 9) GROUP BY 1, 2),
reg AS (SELECT * FROM (VALUES (1, '{EVENT_TOPIC}', '{DEMO_EVENT}'), (1, '{EVENT_TOPIC}', '{DEMO_ENVELOPE}'), (8, '{EVENT_TOPIC}', '{DEMO_ENVELOPE}')) AS r(schema_id, topic, message))
SELECT s.topic, s.schema_id, s.records, r.topic || '-' || r.message AS subject, r.message,
  r.message IS NOT NULL AS registered
FROM seen s LEFT JOIN reg r ON s.topic = r.topic AND s.schema_id = r.schema_id""",
}
ORACLE_SQL["ingest_quarantine"] = ORACLE_SQL["quarantine"]
ORACLE_SQL["census_stream"] = ORACLE_SQL["frame_census"]
ORACLE_SQL["census_beside_ingest"] = ORACLE_SQL["frame_census"].replace(_HARD_OUTCOME, _OUTCOME)
ORACLE_SQL["publish_replay"] = ORACLE_SQL["publish_roundtrip"]
ORACLE_SQL["decoded_payload_filtered"] = f"""{ORACLE_SQL["decoded_payload"]} WHERE event_id % 4 = 1 AND ts >= TIMESTAMP '2024-01-15 00:00:00'"""
ORACLE_SQL["descriptor_file_decode"] = ORACLE_SQL["decoded_payload"]
ORACLE_SQL["ingest_rerun"] = ORACLE_SQL["ingest_append"]
_MIXED_KEYS = _KEYS.replace(EVENT_TOPIC, MIXED_TOPIC)
ORACLE_SQL["mixed_topic_decode"] = f"""SELECT {_MIXED_KEYS}, CASE event_id % 3 WHEN 0 THEN '{DEMO_ENVELOPE}' WHEN 1 THEN '{DEMO_EVENT_BYTES}' ELSE '{DEMO_EVENT}' END AS message,
  CAST(event_id AS VARCHAR) AS id, {_MS} AS created_at_epoch_ms, props AS payload, CASE WHEN event_id % 3 = 0 THEN event_type END AS ce_type
FROM events"""
ORACLE_SQL["quarantine_recovered"] = f"""SELECT CAST(event_id AS VARCHAR) AS id, props AS payload, {_MIXED_KEYS}, event_id % 3 = 1 AS recovered, 0::BIGINT AS open FROM events"""
ORACLE_SQL["offset_gaps"] = f"""WITH t AS (SELECT {_KEYS} FROM events WHERE event_id % 13 NOT IN (2, 6) AND NOT (event_id // 4 BETWEEN 100 AND 120 AND event_id % 4 = 3)),
g AS (SELECT topic, "partition", "offset" AS b, lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS a FROM t)
SELECT topic, "partition", b + 1 AS first_missing, a - 1 AS last_missing, a - b - 1 AS missing FROM g WHERE a - b > 1"""
ORACLE_SQL["ingest_compacted"] = f"""SELECT CASE WHEN {_GOOD} THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN {_GOOD} THEN props END AS payload, {_KEYS}, event_id // 4 % 5 < 4 AS packed, 3::BIGINT AS partitions
FROM events"""
ORACLE_SQL["census_windows"] = f"""WITH t AS (SELECT {_KEYS}, {_SCHEMA_ID} AS schema_id, {_HARD_OUTCOME} AS outcome, date_trunc('day', ts) AS window_start FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, topic, "partition", schema_id, outcome, count(*) AS records,
  min("offset") AS min_offset, max("offset") AS max_offset
FROM t WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR GROUP BY ALL"""
ORACLE_SQL["reconcile_stream"] = f"""WITH seen AS (
  SELECT '{EVENT_TOPIC}' AS topic, {_SCHEMA_ID} AS schema_id, h.half, count(*) AS records
  FROM events JOIN (VALUES (0), (1)) AS h(half) ON event_id // 4 % 2 <= h.half
  WHERE event_id % 10 IN (0, 1, 8, 9) GROUP BY ALL),
reg AS (SELECT * FROM (VALUES (1, '{EVENT_TOPIC}', '{DEMO_EVENT}', 0), (1, '{EVENT_TOPIC}', '{DEMO_ENVELOPE}', 0), (8, '{EVENT_TOPIC}', '{DEMO_ENVELOPE}', 0), (9, '{EVENT_TOPIC}', '{DEMO_EVENT}', 1)) AS r(schema_id, topic, message, since))
SELECT s.topic, s.schema_id, s.records, r.topic || '-' || r.message AS subject, r.message,
  r.message IS NOT NULL AS registered, CAST(s.half AS INTEGER) AS half
FROM seen s LEFT JOIN reg r ON s.topic = r.topic AND s.schema_id = r.schema_id AND r.since <= s.half"""
