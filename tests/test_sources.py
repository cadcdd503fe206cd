"""Topic source/sink, descriptor loading, settings."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from framelake.schemas import DEMO_EVENT
from framelake.session import scratch_path
from framelake.settings import Settings, session_conf
from framelake.sources.descriptors import load_descriptor_set, normalize_path
from framelake.sources.topic import read_topic, write_topic
from framelake.streaming.jobs import event_records


def test_descriptor_set_load(spark, descriptor_set, tmp_path):
    path = tmp_path / "demo.desc"
    path.write_bytes(descriptor_set)
    assert load_descriptor_set(spark, str(path)) == descriptor_set
    assert normalize_path(" s3://bucket/d.desc ") == "s3a://bucket/d.desc"
    assert normalize_path("") == ""


def test_file_topic_append_and_read(spark, descriptor_set):
    settings = Settings(topic_format="parquet", topic="demo.t", topic_path=scratch_path(spark, "topic-test"))
    rows = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("p").alias("payload"))
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), settings)
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), settings)
    topic = read_topic(spark, settings, streaming=False)
    assert topic.count() == 40
    assert topic.where("partition IS NOT NULL OR offset IS NOT NULL").count() == 0  # a broker's to assign
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), settings, run_id="r", batch_id=4)
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), settings, run_id="r", batch_id=4)
    assert read_topic(spark, settings, streaming=False).count() == 60  # a batch of a run lands once
    heads = {r.h for r in topic.select(F.hex(F.substring("value", 1, 6)).alias("h")).collect()}
    assert heads == {"000000000300"}
    assert read_topic(spark, settings.replace(include_headers=False), streaming=False).columns[-1] == "timestampType"


def test_settings_from_env():
    s = Settings.from_env({"KAFKA_TOPIC": "x", "DUAL_STREAM": "yes", "PRINT_MODE": " Headers ", "ICEBERG_QUERY_LIMIT": "7"})
    assert (s.topic, s.dual_stream, s.print_mode, s.query_limit) == ("x", True, "headers", 7)
    conf = session_conf(s.replace(s3_endpoint="http://minio:9000", s3_access_key="a"))
    assert conf["spark.sql.catalog.iceberg.type"] == "rest"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert conf["spark.sql.session.timeZone"] == "UTC"
    assert "spark.sql.extensions" not in session_conf(s.replace(table_format="parquet"))
    assert os.environ.get("NOT_SET_ANYWHERE") is None


def test_cli_settings_and_query_job(spark, tmp_path, monkeypatch):
    from framelake.cli import JOBS, settings_from_env

    s = settings_from_env({"FRAMELAKE_TOPIC_FORMAT": "parquet", "FRAMELAKE_TOPIC_PATH": "/x", "PROTO_MESSAGE_NAME": ""})
    assert (s.topic_format, s.topic_path, s.message_name) == ("parquet", "/x", "")
    assert set(JOBS) == {"ingest", "inspect", "query"}


def test_connector_packages():
    s = Settings().with_connectors("4.1.2")
    assert "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2" in s.packages
    names = session_conf(s)["spark.jars.packages"]
    assert names.count("4.1.2") == 2 and "iceberg-spark-runtime" in names and "iceberg-aws-bundle" in names and "hadoop-aws" not in names
    assert "hadoop-aws" in session_conf(Settings(checkpoint_location="s3a://b/cp").with_connectors("4.1.2"))["spark.jars.packages"]
    offline = Settings(topic_format="parquet", table_format="parquet").with_connectors("4.1.2")
    assert [p.split(":")[1] for p in offline.packages] == ["spark-protobuf_2.13"]


def test_cli_settings_by_job():
    from framelake.cli import settings_from_env, with_packages

    assert settings_from_env({}, job="inspect").message_name == ""
    assert settings_from_env({}, job="ingest").message_name == DEMO_EVENT
    assert settings_from_env({"PROTO_MESSAGE_NAME": "x.Y"}, job="inspect").message_name == "x.Y"
    tuned = settings_from_env({"FRAMELAKE_DECODE_MODE": "permissive", "FRAMELAKE_MAX_OFFSETS_PER_TRIGGER": "500", "FRAMELAKE_MIN_PARTITIONS": "32", "FRAMELAKE_PROTOBUF_IMPL": "arrow"})
    assert (tuned.decode_mode, tuned.max_offsets_per_trigger, tuned.min_partitions, tuned.protobuf_impl) == ("PERMISSIVE", 500, 32, "arrow")
    assert with_packages(settings_from_env({}, job="ingest")).packages and with_packages(settings_from_env({"FRAMELAKE_PACKAGES": "a:b:1"})).packages == ("a:b:1",)


def test_ce_type_follows_the_message(spark, descriptor_set):
    events = event_records(spark.range(1).select(F.col("id").cast("string").alias("id")), DEMO_EVENT, descriptor_set, 3)
    types = events.select(F.expr("CAST(filter(headers, h -> h.key = 'ce_type')[0].value AS STRING)").alias("t")).first().t
    assert types == "com." + DEMO_EVENT


def test_cli_inspect_job_end_to_end(spark, descriptor_set, tmp_path):
    """``python -m framelake inspect`` in its own process, dual mode, run to
    completion over a parquet topic."""
    import subprocess
    import sys

    from conftest import ROOT

    topic = Settings(topic_format="parquet", topic="cli.t", topic_path=scratch_path(spark, "topic-cli"))
    rows = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("hello").alias("payload"))
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), topic)
    desc = tmp_path / "demo.desc"
    desc.write_bytes(descriptor_set)
    env = dict(os.environ)
    env.update(
        {
            "PYTHONPATH": ROOT,
            "KAFKA_TOPIC": "cli.t",
            "FRAMELAKE_TOPIC_FORMAT": "parquet",
            "FRAMELAKE_TOPIC_PATH": topic.topic_path,
            "PROTO_DESCRIPTOR_PATH": str(desc),
            "PROTO_MESSAGE_NAME": DEMO_EVENT,
            "DUAL_STREAM": "true",
            "CHECKPOINT_LOCATION": scratch_path(spark, "cp-cli"),
            "FRAMELAKE_AVAILABLE_NOW": "1",
        }
    )
    done = subprocess.run(
        [sys.executable, "-m", "framelake", "inspect"], env=env, cwd=str(tmp_path), capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("hello") == 5  # payload view printed every record
    assert "com.acme.demo.v1.DemoEvent" in done.stdout  # header view printed too


def test_cli_ingest_job_restarts_without_duplicates(spark, descriptor_set, tmp_path):
    """``python -m framelake ingest`` twice on one checkpoint, with records
    published in between: every record lands once."""
    import subprocess
    import sys

    from conftest import ROOT

    topic = Settings(topic_format="parquet", topic="cli.ingest", topic_path=scratch_path(spark, "topic-cli-ingest"))
    desc = tmp_path / "demo.desc"
    desc.write_bytes(descriptor_set)
    table_path = scratch_path(spark, "table-cli-ingest")
    env = dict(os.environ)
    env.update(
        {
            "PYTHONPATH": ROOT,
            "KAFKA_TOPIC": "cli.ingest",
            "FRAMELAKE_TOPIC_FORMAT": "parquet",
            "FRAMELAKE_TOPIC_PATH": topic.topic_path,
            "FRAMELAKE_TABLE_FORMAT": "parquet",
            "FRAMELAKE_TABLE_PATH": table_path,
            "ICEBERG_CATALOG": "spark_catalog",
            "ICEBERG_NAMESPACE": "cli_ns",
            "PROTO_DESCRIPTOR_PATH": str(desc),
            "PROTO_MESSAGE_NAME": DEMO_EVENT,
            "CHECKPOINT_LOCATION": scratch_path(spark, "cp-cli-ingest"),
            "FRAMELAKE_AVAILABLE_NOW": "1",
        }
    )
    for start, end in ((0, 5), (5, 8)):
        rows = spark.range(start, end).select(F.col("id").cast("string").alias("id"), F.lit("p").alias("payload"))
        write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 3), topic)
        done = subprocess.run(
            [sys.executable, "-m", "framelake", "ingest"], env=env, cwd=str(tmp_path), capture_output=True, text=True, timeout=600
        )
        assert done.returncode == 0, done.stderr[-2000:]
    table = spark.read.parquet(table_path)
    assert table.count() == 8
    assert sorted(int(r.id) for r in table.select("id").collect()) == list(range(8))
