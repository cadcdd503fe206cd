"""Command-line jobs: ``python -m framelake {ingest,inspect,query}``.

Settings come from the environment (``Settings.from_env``), with the same
variable names as the jobs this replaces (KAFKA_TOPIC, PROTO_MESSAGE_NAME,
PRINT_MODE, DUAL_STREAM, ICEBERG_*, CHECKPOINT_LOCATION, ...), plus
FRAMELAKE_TOPIC_FORMAT / FRAMELAKE_TOPIC_PATH / FRAMELAKE_TABLE_FORMAT /
FRAMELAKE_TABLE_PATH to run against a parquet topic and table instead of Kafka
and Iceberg, FRAMELAKE_AVAILABLE_NOW=1 to process what is there and stop, and
FRAMELAKE_DECODE_MODE, FRAMELAKE_PROTOBUF_IMPL, FRAMELAKE_PACKAGES,
FRAMELAKE_MAX_OFFSETS_PER_TRIGGER, FRAMELAKE_MIN_PARTITIONS and
FRAMELAKE_MAX_FILES_PER_TRIGGER for decoding and back-pressure.
"""

from __future__ import annotations

import argparse
import os
import sys

from framelake.functions.framing import register_sql_functions
from framelake.operators.readback import latest_table_rows, list_namespaces, list_tables
from framelake.session import build_session
from framelake.settings import Settings
from framelake.sources.descriptors import load_descriptor_set
from framelake.streaming.jobs import await_queries, start_ingest, start_inspect


def settings_from_env(env=None, job: str | None = None) -> Settings:
    e = os.environ if env is None else env
    overrides = {}
    if job == "inspect":
        overrides["table_format"] = "parquet"  # it has no table, so needs no catalog
        if "PROTO_MESSAGE_NAME" not in e:
            overrides["message_name"] = ""  # its default view is the raw one
    if e.get("FRAMELAKE_TOPIC_FORMAT"):
        overrides["topic_format"] = e["FRAMELAKE_TOPIC_FORMAT"]
    if e.get("FRAMELAKE_TOPIC_PATH"):
        overrides["topic_path"] = e["FRAMELAKE_TOPIC_PATH"]
    if e.get("FRAMELAKE_TABLE_FORMAT"):
        overrides["table_format"] = e["FRAMELAKE_TABLE_FORMAT"]
    if e.get("FRAMELAKE_TABLE_PATH"):
        overrides["table_path"] = e["FRAMELAKE_TABLE_PATH"]
    return Settings.from_env(e, **overrides)


def with_packages(settings: Settings) -> Settings:
    """The connector packages of the chosen formats, unless some are given or
    none is needed: parquet topic and table run on Spark alone."""
    offline = settings.topic_format == "parquet" and settings.table_format == "parquet"
    return settings if offline or settings.packages else settings.with_connectors()


def trigger_from_env(env=None) -> dict | None:
    """``FRAMELAKE_AVAILABLE_NOW=1``: process what is there, then stop."""
    e = os.environ if env is None else env
    return {"availableNow": True} if (e.get("FRAMELAKE_AVAILABLE_NOW") or "").lower() in ("1", "true", "yes") else None


def run_ingest(settings: Settings) -> None:
    """Topic -> strip -> decode -> replay-safe append, until stopped."""
    spark = build_session(settings, app_name="framelake-ingest")
    register_sql_functions(spark, strip_name=settings.strip_function_name)
    trigger = trigger_from_env()
    query = start_ingest(spark, settings, load_descriptor_set(spark, settings.descriptor_path), trigger=trigger)
    await_queries(spark, {"ingest": query}, finite=trigger is not None)


def run_inspect(settings: Settings) -> None:
    """Print the decoded (or raw hex) and/or header views to the console."""
    spark = build_session(settings, app_name="framelake-inspect")
    register_sql_functions(spark, strip_name=settings.strip_function_name)
    descriptor = load_descriptor_set(spark, settings.descriptor_path) if settings.message_name else None
    trigger = trigger_from_env()
    await_queries(spark, start_inspect(spark, settings, descriptor, trigger=trigger), finite=trigger is not None)


def run_query(settings: Settings) -> None:
    """List namespaces and tables, then show the latest rows."""
    spark = build_session(settings, app_name="framelake-query")
    try:
        list_namespaces(spark, settings.catalog).show(truncate=False)
        list_tables(spark, f"{settings.catalog}.{settings.namespace}").show(truncate=False)
        # Two-phase (partition-pruned) on batch-partitioned tables, else the
        # plain ORDER BY ingested_at DESC LIMIT n.
        latest_table_rows(spark, settings.table_name, settings.query_limit).show(settings.query_limit, truncate=False)
    finally:
        spark.stop()


JOBS = {"ingest": run_ingest, "inspect": run_inspect, "query": run_query}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="framelake")
    parser.add_argument("job", choices=sorted(JOBS))
    args = parser.parse_args(argv)
    JOBS[args.job](with_packages(settings_from_env(job=args.job)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
