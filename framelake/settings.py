"""Typed job settings (SRC-5) and the session configuration they imply.

Transforms never read the environment; ``Settings.from_env()`` is the one place
that does, using the same variable names as the jobs this library replaces.
"""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Mapping


def _flag(value: str | None) -> bool:
    return (value or "").strip().lower() in ("1", "true", "yes")


def _count(value: str | None) -> int | None:
    return int(value) if value and value.strip() else None


@dataclasses.dataclass(frozen=True)
class Settings:
    # Topic source: "kafka" (production) or "parquet" (a directory of records
    # in the Kafka source schema, used offline and in tests).
    topic_format: str = "kafka"
    topic: str = "demo.protobuf"
    bootstrap_servers: str = "localhost:9092"
    topic_path: str | None = None
    starting_offsets: str = "latest"
    include_headers: bool = True
    max_offsets_per_trigger: int | None = 5_000_000  # bounds the first batch over a backlog; None for no bound
    min_partitions: int | None = None
    max_files_per_trigger: int | None = None

    # Decoding.
    descriptor_path: str = "../proto/descriptors/demo.desc"
    message_name: str = "acme.demo.v1.DemoEvent"
    decode_mode: str = "FAILFAST"  # or PERMISSIVE (NULL, routed to quarantine)
    protobuf_impl: str = "auto"  # auto | connector | arrow
    strip_function_name: str = "strip_confluent_protobuf"

    # Inspect job.
    print_mode: str = "payload"  # payload | headers
    dual_stream: bool = False
    header_dedup_policy: str = "LAST_WIN"  # Kafka allows repeated header keys

    # Target table.
    table_format: str = "iceberg"  # iceberg | parquet
    catalog: str = "iceberg"
    namespace: str = "demo"
    table: str = "demo_events"
    table_path: str | None = None  # LOCATION of a parquet target (external table)
    catalog_uri: str = "http://localhost:8181"
    warehouse: str = "s3://datalake/warehouse"
    query_limit: int = 50

    # Object store.
    s3_endpoint: str | None = None
    s3_access_key: str | None = None
    s3_secret_key: str | None = None
    aws_region: str = "us-east-1"

    checkpoint_location: str | None = None
    packages: tuple[str, ...] = ()

    @property
    def table_name(self) -> str:
        return f"{self.catalog}.{self.namespace}.{self.table}"

    def replace(self, **changes) -> Settings:
        return dataclasses.replace(self, **changes)

    def with_connectors(self, spark_version: str | None = None) -> Settings:
        """Add the connector packages that the chosen formats need: protobuf,
        Kafka for a Kafka topic, Iceberg and its AWS bundle for an Iceberg
        table, S3A if a path or endpoint asks for it."""
        if spark_version is None:
            import pyspark

            spark_version = pyspark.__version__
        wanted = [PROTOBUF_PACKAGE.format(spark=spark_version)]
        if self.topic_format == "kafka":
            wanted.append(KAFKA_PACKAGE.format(spark=spark_version))
        if self.table_format == "iceberg":
            wanted += [ICEBERG_RUNTIME_PACKAGE, ICEBERG_AWS_PACKAGE]
        paths = (self.descriptor_path, self.checkpoint_location, self.topic_path, self.table_path)
        if self.s3_endpoint or any((p or "").startswith(("s3://", "s3a://")) for p in paths):
            wanted.append(HADOOP_AWS_PACKAGE)
        return self.replace(packages=tuple(dict.fromkeys(list(self.packages) + wanted)))

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Settings:
        e = os.environ if env is None else env
        base = cls()
        values = dict(
            topic=e.get("KAFKA_TOPIC", base.topic),
            bootstrap_servers=e.get("KAFKA_BOOTSTRAP_SERVERS", base.bootstrap_servers),
            starting_offsets=e.get("KAFKA_STARTING_OFFSETS", base.starting_offsets),
            descriptor_path=e.get("PROTO_DESCRIPTOR_PATH", base.descriptor_path),
            message_name=e.get("PROTO_MESSAGE_NAME", base.message_name),
            strip_function_name=e.get("STRIP_UDF_NAME", base.strip_function_name),
            print_mode=e.get("PRINT_MODE", base.print_mode).strip().lower(),
            dual_stream=_flag(e.get("DUAL_STREAM")),
            catalog=e.get("ICEBERG_CATALOG", base.catalog),
            namespace=e.get("ICEBERG_NAMESPACE", base.namespace),
            table=e.get("ICEBERG_TABLE", base.table),
            catalog_uri=e.get("ICEBERG_CATALOG_URI", base.catalog_uri),
            warehouse=e.get("ICEBERG_WAREHOUSE", base.warehouse),
            query_limit=int(e.get("ICEBERG_QUERY_LIMIT", base.query_limit)),
            s3_endpoint=e.get("S3_ENDPOINT", base.s3_endpoint),
            s3_access_key=e.get("S3_ACCESS_KEY", base.s3_access_key),
            s3_secret_key=e.get("S3_SECRET_KEY", base.s3_secret_key),
            aws_region=e.get("AWS_REGION", base.aws_region),
            checkpoint_location=e.get("CHECKPOINT_LOCATION", base.checkpoint_location),
            decode_mode=e.get("FRAMELAKE_DECODE_MODE", base.decode_mode).strip().upper(),
            protobuf_impl=e.get("FRAMELAKE_PROTOBUF_IMPL", base.protobuf_impl),
            max_offsets_per_trigger=_count(e.get("FRAMELAKE_MAX_OFFSETS_PER_TRIGGER", str(base.max_offsets_per_trigger))),
            min_partitions=_count(e.get("FRAMELAKE_MIN_PARTITIONS")),
            max_files_per_trigger=_count(e.get("FRAMELAKE_MAX_FILES_PER_TRIGGER")),
            packages=tuple(p.strip() for p in e.get("FRAMELAKE_PACKAGES", "").split(",") if p.strip()),
        )
        values.update(overrides)
        return cls(**values)


# Connector coordinates for Spark 4.x / Scala 2.13. The Iceberg
# and Hadoop versions are those published for it; set FRAMELAKE_PACKAGES for others.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:{spark}"
PROTOBUF_PACKAGE = "org.apache.spark:spark-protobuf_2.13:{spark}"
ICEBERG_RUNTIME_PACKAGE = "org.apache.iceberg:iceberg-spark-runtime-4.0_2.13:1.10.0"
ICEBERG_AWS_PACKAGE = "org.apache.iceberg:iceberg-aws-bundle:1.10.0"
HADOOP_AWS_PACKAGE = "org.apache.hadoop:hadoop-aws:3.4.1"
ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
ICEBERG_CATALOG_CLASS = "org.apache.iceberg.spark.SparkCatalog"
ICEBERG_S3_FILE_IO = "org.apache.iceberg.aws.s3.S3FileIO"


def session_conf(settings: Settings) -> dict[str, str]:
    """Spark configuration for a job with these settings."""
    conf: dict[str, str] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Arrow batches to the decode UDF are bounded in bytes as well as rows,
        # so large messages cannot make one batch outgrow a worker.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
        "spark.sql.mapKeyDedupPolicy": settings.header_dedup_policy,
    }
    if settings.packages:
        conf["spark.jars.packages"] = ",".join(settings.packages)
    if settings.table_format == "iceberg":
        prefix = f"spark.sql.catalog.{settings.catalog}"
        conf.update(
            {
                "spark.sql.extensions": ICEBERG_EXTENSIONS,
                prefix: ICEBERG_CATALOG_CLASS,
                f"{prefix}.type": "rest",
                f"{prefix}.uri": settings.catalog_uri,
                f"{prefix}.warehouse": settings.warehouse,
                f"{prefix}.io-impl": ICEBERG_S3_FILE_IO,
                f"{prefix}.s3.path-style-access": "true",
                f"{prefix}.s3.region": settings.aws_region,
            }
        )
        if settings.s3_endpoint:
            conf[f"{prefix}.s3.endpoint"] = settings.s3_endpoint
        if settings.s3_access_key:
            conf[f"{prefix}.s3.access-key-id"] = settings.s3_access_key
        if settings.s3_secret_key:
            conf[f"{prefix}.s3.secret-access-key"] = settings.s3_secret_key
    if settings.s3_endpoint:
        conf.update(
            {
                "spark.hadoop.fs.s3a.endpoint": settings.s3_endpoint,
                "spark.hadoop.fs.s3a.path.style.access": "true",
                "spark.hadoop.fs.s3a.connection.ssl.enabled": str(settings.s3_endpoint.startswith("https")).lower(),
            }
        )
    if settings.s3_access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = settings.s3_access_key
    if settings.s3_secret_key:
        conf["spark.hadoop.fs.s3a.secret.key"] = settings.s3_secret_key
    return conf
