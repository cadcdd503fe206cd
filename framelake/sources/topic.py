"""Topic source and sink (SRC-1, SRC-2, SNK-6 write side).

Two implementations behind one function each:

* ``kafka`` - Spark's Kafka connector (production);
* ``parquet`` - a directory of parquet files holding records in the Kafka
  source schema. It is what runs offline and in tests; a streaming read picks
  up new files as they land.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.settings import Settings

HEADER_TYPE = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType(), True), T.StructField("value", T.BinaryType(), True)]),
    True,
)
# The Kafka source's record schema (headers only with includeHeaders=true).
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
        T.StructField("headers", HEADER_TYPE, True),
    ]
)
RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]


def read_topic(spark: SparkSession, settings: Settings, streaming: bool = True) -> DataFrame:
    """Records of ``settings.topic`` as a streaming (or bounded) DataFrame."""
    if settings.topic_format == "kafka":
        reader = spark.readStream if streaming else spark.read
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", settings.bootstrap_servers)
            .option("subscribe", settings.topic)
            .option("includeHeaders", str(settings.include_headers).lower())
        )
        if streaming:
            reader = reader.option("startingOffsets", settings.starting_offsets)
            if settings.max_offsets_per_trigger:
                reader = reader.option("maxOffsetsPerTrigger", str(settings.max_offsets_per_trigger))
        else:
            reader = reader.option("startingOffsets", "earliest").option("endingOffsets", "latest")
        if settings.min_partitions:
            reader = reader.option("minPartitions", str(settings.min_partitions))
        return reader.load()
    if settings.topic_format != "parquet":
        raise ValueError(f"unknown topic_format {settings.topic_format!r}")
    if not settings.topic_path:
        raise ValueError("topic_format 'parquet' needs topic_path")
    reader = (spark.readStream if streaming else spark.read).schema(RECORD_SCHEMA)
    if streaming and settings.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(settings.max_files_per_trigger))
    records = reader.option("recursiveFileLookup", "true").parquet(settings.topic_path).where(F.col("topic") == settings.topic).select(*RECORD_COLUMNS)
    if not settings.include_headers:
        records = records.drop("headers")
    return records


def topic_records(records: DataFrame, settings: Settings) -> DataFrame:
    """``records`` (columns ``key``, ``value`` and optionally ``headers`` and
    ``timestamp``) in the record schema. ``partition`` and ``offset`` are NULL:
    they are a broker's to assign."""
    cols = set(records.columns)
    headers = F.col("headers") if "headers" in cols else F.lit(None).cast(HEADER_TYPE)
    timestamp = F.col("timestamp") if "timestamp" in cols else F.current_timestamp()
    return records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(settings.topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"),
    )


def write_topic(records: DataFrame, settings: Settings, run_id: str | None = None, batch_id: int = 0) -> None:
    """Append records to the topic: through Kafka, or as a folder of its own
    in a parquet topic, named by run and batch. Writing the same batch of
    a run again replaces it, so a replayed publish lands once; without a
    ``run_id`` each call is a run of its own."""
    if settings.topic_format == "kafka":
        headers = F.col("headers") if "headers" in records.columns else F.lit(None).cast(HEADER_TYPE)
        out = records.select("key", "value", headers.alias("headers"))
        (
            out.write.format("kafka")
            .option("kafka.bootstrap.servers", settings.bootstrap_servers)
            .option("topic", settings.topic)
            .save()
        )
        return
    if not settings.topic_path:
        raise ValueError("topic_format 'parquet' needs topic_path")
    folder = f"{settings.topic_path.rstrip('/')}/run-{run_id or uuid.uuid4().hex}/batch-{int(batch_id)}"
    topic_records(records, settings).write.mode("overwrite").parquet(folder)
