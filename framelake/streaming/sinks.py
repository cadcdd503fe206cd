"""Streaming sinks (SNK-1..SNK-5).

Replay safety: Structured Streaming re-runs a micro-batch after a failure
between the sink write and the offset commit, with the same batch id. The
parquet target therefore overwrites the partition ``(run_id, batch_id)``
(``INSERT OVERWRITE`` with a static partition spec) instead of appending, so a
replayed batch replaces its own rows and nothing else. ``run_id`` is stored inside the checkpoint: a new
checkpoint means a new run and can never overwrite an earlier run's batches.
Iceberg targets use Iceberg's streaming sink, which commits each batch id once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.settings import Settings

# The target table's contract columns.
TARGET_DDL = "id STRING, payload STRING, ingested_at TIMESTAMP"
LINEAGE_DDL = "topic STRING, `partition` INT, `offset` BIGINT"
TARGET_COLUMNS = ("id", "payload", "ingested_at", "topic", "partition", "offset")
# Quarantine table: where unusable records go, raw bytes and reason kept.
QUARANTINE_DDL = "topic STRING, `partition` INT, `offset` BIGINT, timestamp TIMESTAMP, key BINARY, value BINARY, outcome STRING, ingested_at TIMESTAMP"
QUARANTINE_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value", "outcome", "ingested_at")
RUN_MARKER = "_framelake_run"


def ensure_target(
    spark: SparkSession, settings: Settings, location: str | None = None, batch_partitioned: bool | None = None
) -> str:
    """SNK-2: create the namespace and table if missing; issued once, before
    the query starts. Returns the table name. Parquet targets (and Iceberg
    targets written by the split ingest) are partitioned by
    ``(run_id, batch_id)`` for replay-safe partition overwrites; a plain
    Iceberg target relies on Iceberg's idempotent streaming commits."""
    name = settings.table_name
    if batch_partitioned is None:
        batch_partitioned = settings.table_format != "iceberg"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {settings.catalog}.{settings.namespace}")
    columns = f"{TARGET_DDL}, {LINEAGE_DDL}"
    if batch_partitioned:
        columns += ", run_id STRING, batch_id BIGINT"
    fmt = "iceberg" if settings.table_format == "iceberg" else "parquet"
    partitioned = " PARTITIONED BY (run_id, batch_id)" if batch_partitioned else ""
    where = f" LOCATION '{location}'" if location and fmt == "parquet" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{partitioned}{where}")
    return name


def ensure_quarantine(spark: SparkSession, settings: Settings, name: str, location: str | None = None) -> str:
    """Create the quarantine table (same catalog and namespace) if missing,
    partitioned by ``(run_id, batch_id)`` like the target."""
    full = f"{settings.catalog}.{settings.namespace}.{name}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {settings.catalog}.{settings.namespace}")
    fmt = "iceberg" if settings.table_format == "iceberg" else "parquet"
    where = f" LOCATION '{location}'" if location and fmt == "parquet" else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({QUARANTINE_DDL}, run_id STRING, batch_id BIGINT) "
        f"USING {fmt} PARTITIONED BY (run_id, batch_id){where}"
    )
    return full


def run_id_for(spark: SparkSession, checkpoint: str) -> str:
    """The run id stored in ``checkpoint``, created on first use; a marker
    that a crash left empty counts as absent."""
    marker = f"{checkpoint.rstrip('/')}/{RUN_MARKER}"

    def stored() -> str | None:
        try:
            row = spark.read.text(marker).first()
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row[0] if row else None

    if stored() is None:
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("run_id")).write.mode("overwrite").text(marker)
    return stored()


def overwrite_batch_partition(batch: DataFrame, table: str, columns, run_id: str, batch_id: int) -> None:
    """Replace partition ``(run_id, batch_id)`` of ``table`` with ``batch``
    (a full static partition spec replaces exactly that partition, whatever
    the session's partitionOverwriteMode is)."""
    view = f"framelake_batch_{run_id}_{int(batch_id)}_{uuid.uuid4().hex[:8]}"
    batch.select(*columns).createOrReplaceTempView(view)
    try:
        batch.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = '{run_id}', batch_id = {int(batch_id)}) "
            f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {view}"
        )
    finally:
        batch.sparkSession.catalog.dropTempView(view)


RECORD_ID = ("topic", "partition", "offset")


def not_landed(batch: DataFrame, table: str, run_id: str) -> DataFrame:
    """The records of ``batch``, one per record id, that no run but ``run_id``
    has put into ``table``; records without an id all stay. This run's own
    partitions are not looked at: its checkpoint keeps it from reading a record
    twice, and a replayed batch must find all its rows again. The other runs'
    lineage columns are read within the batch's range of offsets only, which
    the Parquet statistics of their files answer."""
    known = F.col("offset").isNotNull() & F.col("partition").isNotNull() & F.col("topic").isNotNull()
    others = other_runs(batch.sparkSession, table, run_id)
    if others is None:
        return batch.where(known).dropDuplicates(list(RECORD_ID)).select(*batch.columns).union(batch.where(~known))
    bounds = batch.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
    landed = others.where(F.col("offset").between(bounds["low"], bounds["high"])).select(*RECORD_ID)
    fresh = batch.where(known).dropDuplicates(list(RECORD_ID)).join(landed, list(RECORD_ID), "left_anti")
    return fresh.select(*batch.columns).union(batch.where(~known))


def other_runs(spark: SparkSession, table: str, run_id: str) -> DataFrame | None:
    """The rows of ``table`` that other runs have landed, None if there is no
    other run. They are read by their folders, since Spark lets no statement
    overwrite a partition of a table that it reads."""
    run = F.regexp_extract("partition", r"^run_id=([^/]+)/", 1).alias("run")
    runs = [r["run"] for r in spark.sql(f"SHOW PARTITIONS {table}").select(run).distinct().where(F.col("run") != run_id).collect()]
    if not runs:
        return None
    location = table_location(spark, table)
    return spark.read.schema(f"{TARGET_DDL}, {LINEAGE_DDL}").parquet(*[f"{location}/run_id={r}" for r in runs])


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    (location,) = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").first()
    return location.rstrip("/")


RECOVERED = "recovered_"  # run ids of recoveries


def recover(decoded: DataFrame, table: str, name: str) -> None:
    """DEC-4, the way back: put quarantined records that decode by now into
    ``table``. ``decoded`` is the quarantine with the target's columns, decoded
    with another message or descriptor set; rows whose ``id`` is NULL did not
    decode and stay. The recovery called ``name`` has a partition of its own,
    which running it again replaces; what other runs have landed in the meantime
    is not landed twice."""
    fresh = not_landed(decoded.where(F.col("id").isNotNull()), table, RECOVERED + name)
    overwrite_batch_partition(fresh, table, TARGET_COLUMNS, RECOVERED + name, 0)


def read_quarantine(spark: SparkSession, quarantine_table: str, table: str | None = None) -> DataFrame:
    """The quarantine; with ``table``, only what has not been recovered into it."""
    spark.catalog.refreshTable(quarantine_table)
    kept = spark.table(quarantine_table)
    if table is None:
        return kept
    spark.catalog.refreshTable(table)
    recovered = spark.table(table).where(F.col("run_id").startswith(RECOVERED)).select(*RECORD_ID)
    return kept.join(recovered, list(RECORD_ID), "left_anti").select(*kept.columns)


class ReplaySafeAppend:
    """``foreachBatch`` function writing each micro-batch into its own
    ``(run_id, batch_id)`` partition of a parquet table. With ``across_runs``
    records that another run has landed are left out, so a fresh checkpoint over
    the same records lands them once."""

    def __init__(self, table: str, run_id: str, across_runs: bool = False):
        self.table = table
        self.run_id = run_id
        self.across_runs = across_runs

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.across_runs:
            batch = not_landed(batch, self.table, self.run_id)
        overwrite_batch_partition(batch, self.table, TARGET_COLUMNS, self.run_id, batch_id)


class QuarantineSplitAppend:
    """``foreachBatch`` function for a classified stream (DEC-4): usable
    records to the target table, the rest to the quarantine table. The batch
    is persisted once and written twice; both writes are replay-safe
    partition overwrites."""

    def __init__(self, table: str, quarantine_table: str, run_id: str):
        self.table = table
        self.quarantine_table = quarantine_table
        self.run_id = run_id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from pyspark import StorageLevel

        from framelake.functions.framing import USABLE_OUTCOMES

        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = batch.where(F.col("outcome").isin(*USABLE_OUTCOMES))
            bad = batch.where(~F.col("outcome").isin(*USABLE_OUTCOMES))
            overwrite_batch_partition(good, self.table, TARGET_COLUMNS, self.run_id, batch_id)
            overwrite_batch_partition(bad, self.quarantine_table, QUARANTINE_COLUMNS, self.run_id, batch_id)
        finally:
            batch.unpersist()


def append_stream(
    decoded: DataFrame,
    settings: Settings,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    across_runs: bool = False,
    append: type[ReplaySafeAppend] = ReplaySafeAppend,
) -> StreamingQuery:
    """SNK-1 + SNK-5: append the ingest projection to the target table with
    checkpointed progress. The table must exist (``ensure_target``). A table
    made elsewhere with the three contract columns alone is appended to as it
    is: it has no place for a batch id, so a replayed batch lands twice there."""
    spark = decoded.sparkSession
    present = set(spark.table(settings.table_name).columns)
    columns = [c for c in TARGET_COLUMNS if c in present]
    writer = decoded.select(*columns).writeStream.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    if settings.table_format == "iceberg":
        return writer.format("iceberg").outputMode("append").toTable(settings.table_name)
    if "batch_id" not in present:
        in_order = [c for c in spark.table(settings.table_name).columns if c in columns]
        return writer.foreachBatch(lambda batch, _: batch.select(*in_order).write.insertInto(settings.table_name)).start()
    return writer.foreachBatch(append(settings.table_name, run_id_for(spark, checkpoint), across_runs)).start()


def console_stream(view: DataFrame, checkpoint: str, query_name: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """SNK-3: print each micro-batch (append mode, no truncation)."""
    writer = (
        view.writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


DONE_DIR = "_done"  # hidden from file sources: batch ids whose result is whole
KEPT_RESULTS = 8  # newest results of a complete_stream that stay readable


def complete_stream(
    aggregated: DataFrame,
    table_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """A streaming aggregate in complete mode (the state is the aggregate
    itself, so it stays as small as its key set). Each micro-batch writes its
    result, through ``finish`` if given, and then notes that it is whole;
    ``read_complete`` reads the newest whole one, so a reader or a crash in
    between never sees a missing or half-written result. Results take turns in
    ``KEPT_RESULTS`` folders, so the space they need does not grow with the
    number of batches. A replay of a batch whose result is whole leaves it."""

    def replace(result: DataFrame, batch_id: int) -> None:
        spark, slot = result.sparkSession, f"slot={int(batch_id) % KEPT_RESULTS}"
        if batch_id in _whole_results(spark, table_path):
            return
        (finish(result) if finish else result).write.mode("overwrite").parquet(f"{table_path}/{slot}")
        spark.range(1).select(F.lit(str(batch_id)).alias("value")).write.mode("overwrite").text(f"{table_path}/{DONE_DIR}/{slot}")

    writer = aggregated.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(replace)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _whole_results(spark: SparkSession, table_path: str) -> list[int]:
    """Batch ids of the results that are whole, ``KEPT_RESULTS`` at most."""
    try:
        return [int(r["value"]) for r in spark.read.text(f"{table_path}/{DONE_DIR}").select("value").collect()]
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_complete(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest whole result of a ``complete_stream``."""
    whole = _whole_results(spark, table_path)
    if not whole:
        raise ValueError(f"no result yet under {table_path}")
    return spark.read.parquet(f"{table_path}/slot={max(whole) % KEPT_RESULTS}")


def file_stream(view: DataFrame, path: str, checkpoint: str, query_name: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Parquet file sink (exactly-once through its own commit log); used where
    a view must be kept rather than printed."""
    writer = view.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
