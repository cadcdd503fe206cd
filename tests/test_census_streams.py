"""Streaming aggregates: bounded results, windows of event time, a registry that changes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from framelake.functions.framing import frame
from framelake.operators.quality import registry_table
from framelake.session import scratch_path
from framelake.settings import Settings
from framelake.sources.topic import RECORD_COLUMNS
from framelake.streaming import sinks
from framelake.streaming.jobs import start_census, start_reconcile, start_windowed_census
from framelake.streaming.sinks import KEPT_RESULTS, read_complete

NOW = {"availableNow": True}


@pytest.fixture
def topic(spark):
    return Settings(topic="t", topic_format="parquet", topic_path=scratch_path(spark, "topic"), checkpoint_location=scratch_path(spark, "checkpoint"))


def land(spark, settings, rows):
    """Append records ``(offset, hours or None, schema id)`` to the topic."""
    df = spark.createDataFrame(rows, "offset long, hours int, id int").coalesce(1)
    value = F.lit(None).cast("binary")
    for i in {r[2] for r in rows}:
        value = F.when(F.col("id") == i, frame(F.lit(b"\x0a\x01a"), i)).otherwise(value)
    at = F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.col("hours"))
    df = df.select(
        F.lit(b"k").alias("key"), value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        at.alias("timestamp"), F.lit(0).alias("timestampType"), F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
    df.select(*RECORD_COLUMNS).write.mode("append").parquet(settings.topic_path)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def folders(spark, path):
    return spark.read.parquet(path).select("slot").distinct().count()


def test_results_take_turns_in_a_fixed_number_of_folders(spark, topic, monkeypatch):
    monkeypatch.setattr(sinks, "KEPT_RESULTS", 2)
    path = scratch_path(spark, "census")
    for turn in range(4):
        land(spark, topic, [(turn, 1, 1)])
        run(start_census(spark, topic, path, trigger=NOW))
        assert [r.records for r in read_complete(spark, path).collect()] == [turn + 1]
    assert folders(spark, path) == 2 < KEPT_RESULTS


def test_no_result_yet(spark):
    with pytest.raises(ValueError):
        read_complete(spark, scratch_path(spark, "nothing"))


def test_windows_close_once_and_late_records_are_left_out(spark, topic):
    path = scratch_path(spark, "windows")
    counts = lambda: sorted((r.window_start.hour, r.schema_id, r.records) for r in spark.read.parquet(path).collect())
    land(spark, topic, [(0, 1, 1), (1, 1, 1), (2, 1, 2), (3, 4, 1), (4, None, 1)])
    run(start_windowed_census(spark, topic, path, "1 hour", "1 hour", trigger=NOW))
    assert counts() == [(1, 1, 2), (1, 2, 1)]  # the fourth hour is open
    land(spark, topic, [(5, 1, 1), (6, 4, 1), (7, 9, 1)])  # the first is late
    run(start_windowed_census(spark, topic, path, "1 hour", "1 hour", trigger=NOW))
    assert counts() == [(1, 1, 2), (1, 2, 1), (4, 1, 2)]


def test_ids_show_as_unregistered_until_they_are(spark, topic):
    registry, path = scratch_path(spark, "registry"), scratch_path(spark, "reconcile")
    seen = lambda: sorted((r.schema_id, r.records, r.registered) for r in read_complete(spark, path).collect())
    registry_table(spark, [(1, "t", "m")]).write.parquet(registry)
    land(spark, topic, [(0, 1, 1), (1, 1, 7)])
    run(start_reconcile(spark, topic, registry, path, trigger=NOW))
    assert seen() == [(1, 1, True), (7, 1, False)]
    registry_table(spark, [(1, "t", "m"), (7, "t", "n")]).write.mode("overwrite").parquet(registry)
    land(spark, topic, [(2, 1, 7), (3, 1, 8)])
    run(start_reconcile(spark, topic, registry, path, trigger=NOW))
    assert seen() == [(1, 1, True), (7, 2, True), (8, 1, False)]
