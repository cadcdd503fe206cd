"""Header map, CloudEvents columns and the inspect views (PRJ-*, FN-*)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framelake.operators.views import headers_view, ingest_view, inspect_views, payload_view, raw_view, record_view
from framelake.schemas import DEMO_EVENT
from framelake.settings import Settings
from framelake.sources.topic import RECORD_SCHEMA


def _records(spark, headers):
    row = (bytearray(b"k1"), bytearray(bytes.fromhex("0000000001000A0161")), "t", 0, 5, None, 0, headers)
    return spark.createDataFrame([row], RECORD_SCHEMA)


def test_header_views(spark):
    hdr = [("ce_id", bytearray(b"1")), ("ce_type", bytearray(b"x")), ("other", bytearray(bytes.fromhex("FF61")))]
    base = record_view(_records(spark, hdr))
    row = headers_view(base).first()
    assert (row.key, row.ce_id, row.ce_type, row.ce_specversion, row.ce_source) == ("k1", "1", "x", None, None)
    raw = base.select(F.col("headers")["other"].alias("o")).first().o
    assert raw.encode("utf-8", "surrogatepass") != b""  # invalid UTF-8 is kept, not rejected
    assert raw_view(base).first().value_hex == "0000000001000A0161"
    assert headers_view(record_view(_records(spark, None))).first().ce_id is None


def test_duplicate_header_keys(spark):
    hdr = [("ce_id", bytearray(b"1")), ("ce_id", bytearray(b"2"))]
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    try:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
        with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
            headers_view(record_view(_records(spark, hdr))).collect()
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        assert headers_view(record_view(_records(spark, hdr))).first().ce_id == "2"
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", before)


def test_payload_view_and_selector(spark, descriptor_set):
    records = _records(spark, None)
    row = payload_view(record_view(records), DEMO_EVENT, descriptor_set).first()
    assert (row.id, row.payload) == ("a", None)
    s = Settings(message_name=DEMO_EVENT)
    assert list(inspect_views(records, s, descriptor_set)) == ["payload"]
    assert list(inspect_views(records, s.replace(print_mode="headers"), descriptor_set)) == ["headers"]
    assert list(inspect_views(records, s.replace(dual_stream=True), descriptor_set)) == ["payload", "headers"]
    raw = inspect_views(records, s.replace(message_name=""), None)["payload"]
    assert raw.columns[-1] == "value_hex"
    assert ingest_view(records, DEMO_EVENT, descriptor_set).columns == ["id", "payload", "ingested_at", "topic", "partition", "offset"]


def test_views_prune_unused_work(spark, descriptor_set):
    base = record_view(_records(spark, None))
    plan = headers_view(base)._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan  # the header view never decodes
    plan = payload_view(base, DEMO_EVENT, descriptor_set)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan  # the payload view never builds the map


def test_null_header_key_raises(spark):
    hdr = [(None, bytearray(b"1"))]
    with pytest.raises(Exception, match="NULL_MAP_KEY"):
        headers_view(record_view(_records(spark, hdr))).collect()
