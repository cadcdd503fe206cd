"""Layout of a parquet target partitioned by micro-batch (SNK-1, SNK-2, SRT-1):
a zone map, compaction by day of ingest, and reads that use both.

The zone map ``<table>_zones`` has a row for each partition of the target: its
rows, how many of them have an ``ingested_at``, and the least and greatest one.
It is written after the partition, so a partition without a row there is one
whose batch is being written (or was written without a zone map), and readers
take it as it is.

Compaction packs the batches of a day into one partition (run ``packed_<day>``)
and commits by the zone row of that partition, which names the batches it holds:
from then on ``live_partitions`` leaves those out and the packed one in, and
their partitions are dropped. A crash before that row leaves a packed partition
that nobody reads, a crash after it batches that nobody reads; the next
compaction drops either. The newest batch of a run is never packed, since it is
the one that Structured Streaming may replay; a batch has been committed once its
successor exists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.operators.readback import DEFAULT_LATEST_LIMIT, latest_rows, read_table
from framelake.streaming.sinks import LINEAGE_DDL, TARGET_COLUMNS, TARGET_DDL, ReplaySafeAppend, overwrite_batch_partition, table_location

ZONE_DDL = "n_rows BIGINT, n_timed BIGINT, least TIMESTAMP, greatest TIMESTAMP, sources ARRAY<STRING>"
ZONE_COLUMNS = ("n_rows", "n_timed", "least", "greatest", "sources")
PACKED = "packed_"  # run ids of packed partitions, before the day
UNTIMED_DAY = "untimed"  # batches without any ingested_at
FILE_BYTES = 128 << 20  # of a packed file
_DROPPED_AT_ONCE = 500


def zones_of(table: str) -> str:
    return f"{table}_zones"


def ensure_zones(spark: SparkSession, table: str) -> str:
    """The target's zone map, made beside it if missing."""
    where = f"{table_location(spark, table)}_zones"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {zones_of(table)} ({ZONE_DDL}, run_id STRING, batch_id BIGINT) "
        f"USING parquet PARTITIONED BY (run_id, batch_id) LOCATION '{where}'"
    )
    return zones_of(table)


def _folder(spark: SparkSession, table: str, name: str) -> str:
    run, batch_id = name.rsplit("/", 1)
    return f"{table_location(spark, table)}/run_id={run}/batch_id={batch_id}"


def _rows_at(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Target rows by folder: no statement may overwrite a partition of a table that it reads."""
    return spark.read.schema(f"{TARGET_DDL}, {LINEAGE_DDL}").parquet(*folders)


def note_zone(spark: SparkSession, table: str, run_id: str, batch_id: int, sources: list[str] | None = None) -> None:
    """Write the zone row of a partition, from the partition as it was written
    (one narrow column is read), so that a replay writes the same row again."""
    written = _rows_at(spark, [_folder(spark, table, f"{run_id}/{int(batch_id)}")])
    held = F.lit(None) if sources is None else F.array(*[F.lit(s) for s in sources])
    zone = written.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ingested_at").alias("n_timed"),
        F.min("ingested_at").alias("least"),
        F.max("ingested_at").alias("greatest"),
    ).withColumn("sources", held.cast("array<string>"))
    overwrite_batch_partition(zone, zones_of(table), ZONE_COLUMNS, run_id, batch_id)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """``name, run_id, batch_id`` of the partitions the catalog lists."""
    part = lambda k: F.regexp_extract("partition", r"^run_id=([^/]+)/batch_id=(\d+)$", k)
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(part(1).alias("run_id"), part(2).cast("bigint").alias("batch_id"))
    return listed.select(F.concat_ws("/", "run_id", "batch_id").alias("name"), "run_id", "batch_id")


def packed_batches(spark: SparkSession, table: str) -> DataFrame:
    """``name`` of the batches that packed partitions hold."""
    return read_table(spark, zones_of(table)).select(F.explode("sources").alias("name")).distinct()


def _unfinished() -> F.Column:
    return F.col("run_id").startswith(PACKED) & F.col("n_rows").isNull()


def live_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The partitions that hold the target's rows, each row once, with their
    zones (null where a partition has none)."""
    zones = read_table(spark, zones_of(table)).select("run_id", "batch_id", *ZONE_COLUMNS[:-1])
    listed = partitions(spark, table).join(zones, ["run_id", "batch_id"], "left")
    return listed.join(packed_batches(spark, table), "name", "left_anti").where(~_unfinished())


def _in_partitions(table: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of some partitions. Their names, no more than the driver lists when
    it plans a scan of the table, are broadcast and prune it at run time."""
    return table.join(F.broadcast(names.select("run_id", "batch_id")), ["run_id", "batch_id"], "left_semi")


def read_target(spark: SparkSession, table: str) -> DataFrame:
    """SRC-3 for a target with a zone map: each row once, also while a
    compaction is at work or after one was cut short."""
    return _in_partitions(read_table(spark, table), live_partitions(spark, table))


def newest_partitions(zones: DataFrame, n: int) -> DataFrame:
    """The partitions that can hold one of the ``n`` rows of greatest
    ``ingested_at``. Taken by their least time, newest first, until they hold n
    timed rows, they show that n rows are no older than the last one's least
    time; a partition whose greatest time is older holds none of the newest.
    Partitions without a zone stay, and all do if there are fewer than n timed rows.
    The windows run over the zone rows alone."""
    in_order = Window.orderBy(F.col("least").desc_nulls_last(), "run_id", "batch_id").rowsBetween(Window.unboundedPreceding, 0)
    held = zones.withColumn("held", F.sum("n_timed").over(in_order))
    bounded = held.withColumn("bound", F.max(F.when(F.col("held") >= n, F.col("least"))).over(Window.partitionBy()))
    return bounded.where(F.col("bound").isNull() | F.coalesce(F.col("greatest") >= F.col("bound"), F.col("n_rows").isNull())).drop("held", "bound")


def latest_target_rows(spark: SparkSession, table: str, n: int = DEFAULT_LATEST_LIMIT) -> DataFrame:
    """SRT-1 by zone map: the top-n over the partitions that can hold it; no
    other data is read, and none to find them."""
    return latest_rows(_in_partitions(read_table(spark, table), newest_partitions(live_partitions(spark, table), n)), n)


class ZonedAppend(ReplaySafeAppend):
    """``ReplaySafeAppend`` that keeps the zone map. A batch that a packed
    partition holds by now is not written again."""

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not packed_batches(spark, self.table).where(F.col("name") == f"{self.run_id}/{int(batch_id)}").isEmpty():
            return
        super().__call__(batch, batch_id)
        note_zone(spark, self.table, self.run_id, batch_id)


def _drop(spark: SparkSession, table: str, names: list[str]) -> None:
    for at in range(0, len(names), _DROPPED_AT_ONCE):
        split = [name.rsplit("/", 1) for name in names[at : at + _DROPPED_AT_ONCE]]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION (run_id = '{r}', batch_id = {b})" for r, b in split))


def _drop_dead(spark: SparkSession, table: str) -> None:
    """Drop what a commit has replaced, and packed partitions that were never committed."""
    zones = read_table(spark, zones_of(table)).select("run_id", "batch_id", "n_rows")
    listed = partitions(spark, table).join(zones, ["run_id", "batch_id"], "left")
    dead = listed.join(packed_batches(spark, table), "name", "left_semi").unionByName(listed.where(_unfinished()))
    names = [r["name"] for r in dead.select("name").distinct().collect()]
    _drop(spark, table, names)
    _drop(spark, zones_of(table), names)


def compact(spark: SparkSession, table: str, min_batches: int = 2, file_bytes: int = FILE_BYTES) -> list[str]:
    """Pack, day by day, the batches of a target that can no longer be replayed
    into one partition a day (a further one where the day gets more batches
    later) and return the names of the new partitions. Files have about
    ``file_bytes`` and are ranges of topic, partition and offset, so a day of any
    size is many tasks and a range of offsets is found by file statistics. Days
    with fewer than ``min_batches`` such batches stay as they are. One
    compaction of a table may run at a time, beside its streams and readers;
    the files it replaces stay for readers at work (``replaced_folders``)."""
    _drop_dead(spark, table)
    newest = F.max("batch_id").over(Window.partitionBy("run_id"))
    closed = live_partitions(spark, table).withColumn("newest", newest).where("batch_id < newest").where(F.col("n_rows").isNotNull() & ~F.col("run_id").startswith(PACKED))
    day = F.coalesce(F.date_format("greatest", "yyyyMMdd"), F.lit(UNTIMED_DAY))
    days = closed.groupBy(day.alias("day")).agg(F.sort_array(F.collect_list("name")).alias("names")).where(F.size("names") >= min_batches)
    packed = []
    for row in days.orderBy("day").collect():  # names of partitions, which the catalog lists on the driver anyway
        run, names = PACKED + row["day"], row["names"]
        batch_id = _next_generation(spark, table, run)
        rows = _rows_at(spark, [_folder(spark, table, n) for n in names])
        size = rows.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
        files = max(1, -(-size // file_bytes))
        overwrite_batch_partition(rows.repartitionByRange(files, "topic", "partition", "offset", "id"), table, TARGET_COLUMNS, run, batch_id)
        note_zone(spark, table, run, batch_id, names)
        _drop(spark, table, names)
        _drop(spark, zones_of(table), names)
        packed.append(f"{run}/{batch_id}")
    return packed


def _next_generation(spark: SparkSession, table: str, run: str) -> int:
    """One more than any packed partition of the day, with or without a zone."""
    known = [partitions(spark, t).where(F.col("run_id") == run).select("batch_id") for t in (table, zones_of(table))]
    last = reduce(DataFrame.union, known).agg(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1


def replaced_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders of batches that a packed partition holds and the catalog no
    longer lists: nothing reads them but statements that began before the
    compaction, so a storage lifecycle rule may remove them."""
    gone = packed_batches(spark, table).join(partitions(spark, table), "name", "left_anti")
    return sorted(_folder(spark, table, r["name"]) for r in gone.collect())
