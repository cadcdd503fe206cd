"""Read-back: latest rows (top-k), sample rows, catalog listing."""

from __future__ import annotations

import datetime as dt

from framelake.operators.readback import latest_rows, latest_rows_sql, list_catalogs, list_namespaces, list_tables, sample_rows
from framelake.session import scratch_path
from framelake.settings import Settings
from framelake.streaming.sinks import ensure_target


def test_latest_rows_tie_break_and_plan(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(str(i), "p", t if i < 8 else t.replace(hour=1), "x", i % 2, i) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, payload string, ingested_at timestamp, topic string, partition int, offset bigint")
    out = [r.id for r in latest_rows(df, 4).collect()]
    assert out == ["9", "8", "7", "6"]  # newest batch first, then highest offset
    assert "TakeOrderedAndProject" in latest_rows(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert sample_rows(df).count() == 10 and sample_rows(df, 3).count() == 3


def test_catalog_listing(spark):
    s = Settings(table_format="parquet", catalog="spark_catalog", namespace="framelake_catalog_test", table="events_x")
    name = ensure_target(spark, s, location=scratch_path(spark, "table-catalog"))
    assert "spark_catalog" in {r.catalog for r in list_catalogs(spark).collect()}
    assert "framelake_catalog_test" in {r.namespace for r in list_namespaces(spark, "spark_catalog").collect()}
    assert "events_x" in {r.tableName for r in list_tables(spark, "spark_catalog.framelake_catalog_test").collect()}
    assert latest_rows_sql(spark, name, 5).count() == 0


def test_latest_rows_reads_only_the_partitions_holding_them(spark, descriptor_set):
    from pyspark.sql import functions as F

    from framelake.operators.readback import latest_table_rows
    from framelake.streaming.sinks import ReplaySafeAppend, run_id_for

    s = Settings(table_format="parquet", catalog="spark_catalog", namespace="framelake_catalog_test", table="latest_x")
    name = ensure_target(spark, s, location=scratch_path(spark, "table-latest"))
    writer = ReplaySafeAppend(name, run_id_for(spark, scratch_path(spark, "cp-latest")))
    for b in range(3):
        batch = spark.range(b * 10, b * 10 + 10).select(
            F.col("id").cast("string").alias("id"),
            F.lit("p").alias("payload"),
            (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.lit(b))).alias("ingested_at"),
            F.lit("t").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("id").alias("offset"),
        )
        writer(batch, b)
    out = latest_table_rows(spark, name, 5)
    assert [r.id for r in out.collect()] == ["29", "28", "27", "26", "25"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert [r.id for r in latest_table_rows(spark, name, 12).collect()][-2:] == ["19", "18"]


def test_contract_view(spark):
    from framelake.operators.readback import contract_view

    s = Settings(table_format="parquet", catalog="spark_catalog", namespace="framelake_catalog_test", table="contract_x")
    name = ensure_target(spark, s, location=scratch_path(spark, "table-contract"))
    assert contract_view(spark, name, "demo_events_contract").columns == ["id", "payload", "ingested_at"]
