"""Streaming ingest: restart, replay, fresh checkpoints, dual stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from framelake.operators.readback import read_table
from framelake.schemas import DEMO_EVENT
from framelake.session import scratch_path
from framelake.settings import Settings
from framelake.sources.topic import read_topic, write_topic
from framelake.operators.views import ingest_view
from framelake.streaming.jobs import await_queries, event_records, start_ingest, start_inspect
from framelake.streaming.sinks import ReplaySafeAppend, ensure_target, read_complete, run_id_for

ONCE = {"availableNow": True}


def _settings(spark, name):
    return Settings(
        topic_format="parquet",
        topic="demo.stream",
        topic_path=scratch_path(spark, f"topic-{name}"),
        table_format="parquet",
        catalog="spark_catalog",
        namespace="framelake_test",
        table=f"t_{name}",
        message_name=DEMO_EVENT,
        checkpoint_location=scratch_path(spark, f"checkpoint-{name}"),
    )


def _publish(spark, settings, descriptor_set, start, end):
    rows = spark.range(start, end).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), F.col("id")).alias("payload"))
    write_topic(event_records(rows, DEMO_EVENT, descriptor_set, 1), settings)


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_restart_resumes_without_duplicates(spark, descriptor_set):
    s = _settings(spark, "restart")
    loc = scratch_path(spark, "table-restart")
    _publish(spark, s, descriptor_set, 0, 20)
    _run(start_ingest(spark, s, descriptor_set, trigger=ONCE, table_location=loc))
    assert read_table(spark, s.table_name).count() == 20
    _publish(spark, s, descriptor_set, 20, 30)
    _run(start_ingest(spark, s, descriptor_set, trigger=ONCE, table_location=loc))  # same checkpoint
    table = read_table(spark, s.table_name)
    assert table.count() == 30
    assert table.select("id").distinct().count() == 30
    assert table.where("ingested_at IS NULL OR payload IS NULL").count() == 0


def test_replayed_batch_lands_once_and_new_run_never_overwrites(spark, descriptor_set):
    s = _settings(spark, "replay")
    _publish(spark, s, descriptor_set, 0, 15)
    table = ensure_target(spark, s, location=scratch_path(spark, "table-replay"))
    batch = ingest_view(read_topic(spark, s, streaming=False), DEMO_EVENT, descriptor_set)
    checkpoint = scratch_path(spark, "checkpoint-replay-a")
    run = run_id_for(spark, checkpoint)
    assert run_id_for(spark, checkpoint) == run  # stable for one checkpoint
    writer = ReplaySafeAppend(table, run)
    writer(batch, 0)
    writer(batch, 0)
    writer(batch.limit(5), 1)
    assert read_table(spark, table).count() == 20
    fresh = ReplaySafeAppend(table, run_id_for(spark, scratch_path(spark, "checkpoint-replay-b")))
    assert fresh.run_id != run
    fresh(batch, 0)  # a fresh checkpoint restarts batch ids at 0
    assert read_table(spark, table).count() == 35


def test_dual_stream_and_console(spark, descriptor_set, capsys):
    s = _settings(spark, "dual").replace(dual_stream=True)
    _publish(spark, s, descriptor_set, 0, 12)
    paths = {"payload": scratch_path(spark, "dual-payload"), "headers": scratch_path(spark, "dual-headers")}
    queries = start_inspect(spark, s, descriptor_set, trigger=ONCE, sink_paths=paths)
    assert {q.name for q in queries.values()} == {"kafka_consumer_payload", "kafka_consumer_headers"}
    for q in queries.values():
        _run(q)
    assert spark.read.parquet(paths["payload"]).count() == 12
    assert spark.read.parquet(paths["headers"]).where("ce_specversion = '1.0'").count() == 12
    # Console sink, single view.
    single = start_inspect(spark, s.replace(dual_stream=False, print_mode="headers", checkpoint_location=scratch_path(spark, "cp-console")), descriptor_set, trigger=ONCE)
    _run(single["headers"])


def test_await_stops_the_other_query(spark, descriptor_set):
    s = _settings(spark, "await")
    _publish(spark, s, descriptor_set, 0, 3)
    records = read_topic(spark, s, streaming=True)
    finite = records.writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", scratch_path(spark, "cp-a")).start()
    endless = records.writeStream.format("noop").trigger(processingTime="1 second").option("checkpointLocation", scratch_path(spark, "cp-b")).start()
    await_queries(spark, {"a": finite, "b": endless}, poll_seconds=1)
    assert not endless.isActive


def test_split_ingest_quarantines_without_stopping(spark, descriptor_set):
    from framelake.sources.topic import RECORD_SCHEMA
    from framelake.streaming.jobs import start_census, start_ingest_with_quarantine

    s = _settings(spark, "split")
    _publish(spark, s, descriptor_set, 0, 6)
    bad = [(None, bytearray(bytes.fromhex(v)), "demo.stream", 9, 100 + i, None, 0, None) for i, v in enumerate(["010203", "0000000000"])]
    spark.createDataFrame(bad, RECORD_SCHEMA).write.mode("append").parquet(s.topic_path)
    q = start_ingest_with_quarantine(
        spark, s, descriptor_set, "q_split", trigger=ONCE,
        table_location=scratch_path(spark, "t-split"), quarantine_location=scratch_path(spark, "q-split"),
    )
    _run(q)
    assert read_table(spark, s.table_name).count() == 6
    reasons = sorted(r.outcome for r in read_table(spark, f"spark_catalog.framelake_test.q_split").collect())
    assert reasons == ["decode_error", "too_short"]
    path = scratch_path(spark, "census-split")
    _run(start_census(spark, s.replace(checkpoint_location=scratch_path(spark, "cp-census")), path, descriptor_set, trigger=ONCE))
    got = {(r.outcome, r.records) for r in read_complete(spark, path).groupBy("outcome").agg(F.sum("records").alias("records")).collect()}
    assert got == {("framed", 6), ("decode_error", 1), ("too_short", 1)}


def test_streaming_publish(spark, descriptor_set):
    from framelake.streaming.jobs import start_publish

    source = _settings(spark, "pub-src")
    _publish(spark, source, descriptor_set, 0, 8)
    rows = read_topic(spark, source, streaming=True).select(F.col("key").cast("string").alias("id"), F.lit("x").alias("payload"))
    target = _settings(spark, "pub-dst")
    _run(start_publish(rows, target, descriptor_set, 4, trigger=ONCE))
    out = read_topic(spark, target, streaming=False)
    assert out.count() == 8
    assert {r.h for r in out.select(F.hex(F.substring("value", 1, 6)).alias("h")).collect()} == {"000000000400"}


def test_crash_after_write_before_commit_replays_once(spark, descriptor_set):
    """Spark replays a batch whose sink write finished but whose commit did
    not; the replayed batch must replace, not duplicate, its rows."""
    from framelake.streaming.sinks import append_stream

    s = _settings(spark, "crash")
    _publish(spark, s, descriptor_set, 0, 25)
    table = ensure_target(spark, s, location=scratch_path(spark, "table-crash"))
    run = run_id_for(spark, s.checkpoint_location)
    writer = ReplaySafeAppend(table, run)

    def crash_after_write(batch, batch_id):
        writer(batch, batch_id)
        raise RuntimeError("simulated crash before the offset commit")

    decoded = ingest_view(read_topic(spark, s.replace(include_headers=False), streaming=True), DEMO_EVENT, descriptor_set)
    failing = (
        decoded.writeStream.option("checkpointLocation", s.checkpoint_location)
        .trigger(availableNow=True)
        .foreachBatch(crash_after_write)
        .start()
    )
    try:
        failing.awaitTermination()
    except Exception:  # noqa: BLE001 - the injected failure
        pass
    assert read_table(spark, table).count() == 25  # written, but the batch is not committed
    _run(append_stream(decoded, s, s.checkpoint_location, trigger=ONCE))  # restart: batch 0 replayed
    t = read_table(spark, table)
    assert t.count() == 25
    assert t.select("batch_id").distinct().count() == 1


def test_jobs_with_the_same_settings_have_their_own_checkpoints(spark):
    from framelake.streaming.jobs import _checkpoint

    s = Settings(topic="a.b", table="t1", checkpoint_location="/x/cp/")
    assert [_checkpoint(None, s, job) for job in ("ingest", "census")] == ["/x/cp/ingest", "/x/cp/census"]
    default = s.replace(checkpoint_location=None)
    assert _checkpoint(spark, default, "ingest") == _checkpoint(spark, default, "ingest")
    assert len({_checkpoint(spark, x, "ingest") for x in (default, default.replace(table="t2"))}) == 2


def test_no_configured_folder_is_an_error_in_every_process(tmp_path):
    """Two processes, no checkpoint folder configured: no job may make one up."""
    import os
    import subprocess
    import sys

    from conftest import ROOT

    code = (
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from framelake.settings import Settings\nfrom framelake.streaming.jobs import _checkpoint\n"
        "try:\n    print('made', _checkpoint(s, Settings(), 'ingest'))\nexcept ValueError as e:\n    print('refused', 'CHECKPOINT_LOCATION' in str(e))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path)}
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], env=env, cwd=str(tmp_path), capture_output=True, text=True, timeout=300)
        assert done.stdout.strip().endswith("refused True"), done.stdout + done.stderr[-500:]


def test_half_written_run_marker_is_written_again(spark):
    from framelake.streaming.sinks import RUN_MARKER

    checkpoint = scratch_path(spark, "cp-marker")
    spark.range(0).selectExpr("'x' AS run_id").write.text(f"{checkpoint}/{RUN_MARKER}")
    run = run_id_for(spark, checkpoint)
    assert run and run_id_for(spark, checkpoint) == run


def test_three_column_contract_table_is_accepted(spark, descriptor_set):
    s = _settings(spark, "contract3")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {s.catalog}.{s.namespace}")
    spark.sql(f"CREATE TABLE {s.table_name} (id STRING, payload STRING, ingested_at TIMESTAMP) USING parquet LOCATION '{scratch_path(spark, 'table-contract3')}'")
    _publish(spark, s, descriptor_set, 0, 7)
    _run(start_ingest(spark, s, descriptor_set, trigger=ONCE))
    assert read_table(spark, s.table_name).where("id IS NOT NULL AND payload IS NOT NULL AND ingested_at IS NOT NULL").count() == 7


def test_framing_inside_foreach_batch_and_in_a_second_session(spark, descriptor_set):
    from framelake.functions.framing import strip_framing
    from framelake.operators.quality import classify

    s = _settings(spark, "sessions")
    _publish(spark, s, descriptor_set, 0, 4)
    outcomes = []
    records = read_topic(spark, s, streaming=True)
    query = records.writeStream.option("checkpointLocation", scratch_path(spark, "cp-sessions")).trigger(availableNow=True)
    _run(query.foreachBatch(lambda batch, _: outcomes.extend(r.outcome for r in classify(batch).select("outcome").collect())).start())
    assert outcomes == ["framed"] * 4
    other = spark.newSession()
    value = other.createDataFrame([(bytearray(bytes.fromhex("0000000007" "0405AC02" "AABB")),)], "value binary")
    assert bytes(value.select(strip_framing("value").alias("m")).first().m) == b"\xaa\xbb"


def test_replayed_publish_lands_once(spark, descriptor_set):
    """The batch of a publish stream whose commit was lost, published again."""
    from framelake.streaming.jobs import _checkpoint, start_publish

    source, target = _settings(spark, "rep-src"), _settings(spark, "rep-dst")
    _publish(spark, source, descriptor_set, 0, 6)
    rows = read_topic(spark, source, streaming=True).select(F.col("key").cast("string").alias("id"), F.lit("x").alias("payload"))
    _run(start_publish(rows, target, descriptor_set, 4, trigger=ONCE))
    run = run_id_for(spark, _checkpoint(spark, target, "publish"))
    again = read_topic(spark, source, streaming=False).select(F.col("key").cast("string").alias("id"), F.lit("x").alias("payload"))
    write_topic(event_records(again, DEMO_EVENT, descriptor_set, 4), target, run, 0)
    assert read_topic(spark, target, streaming=False).count() == 6
