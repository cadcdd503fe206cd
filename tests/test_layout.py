"""Zone map, compaction and the reads that use them."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from framelake.operators.readback import latest_rows
from framelake.session import scratch_path
from framelake.settings import Settings
from framelake.streaming import layout
from framelake.streaming.layout import ZonedAppend, compact, ensure_zones, latest_target_rows, live_partitions, newest_partitions, read_target, replaced_folders
from framelake.streaming.sinks import ensure_target

HOURS = (0, 5, 30, 29, 50, 49)  # two batches a day, not in order


@pytest.fixture
def target(spark):
    settings = Settings(table_format="parquet", catalog="spark_catalog", namespace="framelake_layout_test", table=f"t_{uuid.uuid4().hex[:8]}")
    name = ensure_target(spark, settings, location=scratch_path(spark, "table-layout"))
    ensure_zones(spark, name)
    return name


def batch(spark, number, hours, rows=10):
    return spark.range(number * rows, number * rows + rows).select(
        F.col("id").cast("string").alias("id"),
        F.lit("p").alias("payload"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.lit(hours))).alias("ingested_at"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )


def fill(spark, table, run="run"):
    writer = ZonedAppend(table, run)
    for number, hours in enumerate(HOURS):
        writer(batch(spark, number, hours), number)
    return writer


def ids(df):
    return sorted(int(r["id"]) for r in df.select("id").collect())


def names(spark, table):
    return sorted(r["name"] for r in live_partitions(spark, table).collect())


def test_compaction_keeps_every_row_once_and_the_newest_batch_apart(spark, target):
    fill(spark, target)
    assert compact(spark, target) == ["packed_20240101/0", "packed_20240102/0"]
    assert names(spark, target) == ["packed_20240101/0", "packed_20240102/0", "run/4", "run/5"]  # a day of one closed batch stays
    assert ids(read_target(spark, target)) == ids(spark.table(target)) == list(range(60))
    assert compact(spark, target) == []
    assert len(replaced_folders(spark, target)) == 4


def test_a_replay_after_compaction_lands_once(spark, target):
    writer = fill(spark, target)
    compact(spark, target)
    writer(batch(spark, 5, HOURS[5]), 5)  # the newest, replayed
    writer(batch(spark, 0, HOURS[0]), 0)  # one that is packed
    assert ids(read_target(spark, target)) == list(range(60))


def test_more_batches_of_a_packed_day_are_packed_apart(spark, target):
    writer = fill(spark, target)
    compact(spark, target)
    for number in (6, 7, 8):
        writer(batch(spark, number, 3), number)
    assert compact(spark, target) == ["packed_20240101/1", "packed_20240103/0"]
    assert ids(read_target(spark, target)) == list(range(90))


@pytest.mark.parametrize("failing", ["note_zone", "_drop"])
def test_a_compaction_cut_short_is_not_seen_and_made_good(spark, target, monkeypatch, failing):
    fill(spark, target)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if failing == "_drop":
            patch.setattr(layout, "_drop_dead", lambda *_: None)
        patch.setattr(layout, failing, stop)
        with pytest.raises(RuntimeError):
            compact(spark, target)
    assert ids(read_target(spark, target)) == list(range(60))
    compact(spark, target)
    assert ids(read_target(spark, target)) == ids(spark.table(target)) == list(range(60))


@pytest.mark.parametrize("n", [1, 5, 10, 11, 25, 60, 100])
def test_latest_rows_by_zones(spark, target, n):
    fill(spark, target)
    want = [r["id"] for r in latest_rows(spark.table(target), n).collect()]
    assert [r["id"] for r in latest_target_rows(spark, target, n).collect()] == want
    compact(spark, target)
    assert [r["id"] for r in latest_target_rows(spark, target, n).collect()] == want


def test_only_partitions_that_can_hold_the_newest_are_read(spark, target):
    fill(spark, target)
    newest = lambda n: sorted(r["name"] for r in newest_partitions(live_partitions(spark, target), n).collect())
    assert newest(10) == ["run/4"] and newest(11) == ["run/4", "run/5"] and len(newest(61)) == 6
    plan = latest_target_rows(spark, target, 5)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_nulls_empty_batches_and_partitions_without_a_zone(spark, target):
    writer = ZonedAppend(target, "run")
    writer(batch(spark, 0, 1).withColumn("ingested_at", F.lit(None).cast("timestamp")), 0)
    writer(batch(spark, 1, 1).limit(0), 1)
    writer(batch(spark, 2, 2), 2)
    super(ZonedAppend, writer).__call__(batch(spark, 3, 0), 3)  # its zone is not written yet
    assert [r["id"] for r in latest_target_rows(spark, target, 12).collect()][:11] == [*[str(i) for i in range(29, 19, -1)], "39"]
    assert compact(spark, target) == ["packed_untimed/0"]
    assert ids(read_target(spark, target)) == [*range(10), *range(20, 40)]


def test_an_empty_target(spark, target):
    assert compact(spark, target) == [] and latest_target_rows(spark, target).collect() == [] and read_target(spark, target).count() == 0
