"""Classification, quarantine, census and schema-id reconciliation."""

from __future__ import annotations


from framelake.operators.quality import (
    classify,
    frame_census,
    quarantined,
    registry_table,
    schema_reconcile,
    unregistered,
)
from framelake.schemas import DEMO_EVENT
from framelake.sources.topic import RECORD_SCHEMA


def _topic(spark, values):
    rows = [(None, None if v is None else bytearray(bytes.fromhex(v)), "t", 0, i, None, 0, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


VALUES = ["0000000001000A0161", "0000000002000A0162", "0A0163", "010203", "0000000000", None, "", "0000000009000A0164"]


def test_classify_and_quarantine(spark, descriptor_set):
    c = classify(_topic(spark, VALUES), DEMO_EVENT, descriptor_set)
    outcomes = [r.outcome for r in c.orderBy("offset").collect()]
    assert outcomes == ["framed", "framed", "plain", "decode_error", "too_short", "null_value", "empty", "framed"]
    q = quarantined(c)
    assert sorted(r.offset for r in q.collect()) == [3, 4, 5, 6]
    census = {(r.schema_id, r.outcome): (r.records, r.min_offset, r.max_offset) for r in frame_census(c).collect()}
    assert census[(1, "framed")] == (1, 0, 0)
    assert census[(None, "plain")] == (1, 2, 2)


def test_reconcile(spark):
    c = classify(_topic(spark, VALUES))
    report = schema_reconcile(c, registry_table(spark, [(1, "t", DEMO_EVENT), (2, "other", DEMO_EVENT)]))
    rows = {r.schema_id: r for r in report.collect()}
    assert rows[1].registered and rows[1].subject == "t-acme.demo.v1.DemoEvent"
    assert not rows[2].registered  # registered under another topic only
    assert {r.schema_id for r in unregistered(report).collect()} == {2, 9}


def test_reconcile_keeps_every_subject_of_an_id(spark):
    c = classify(_topic(spark, VALUES))
    registry = registry_table(spark, [(1, "t", DEMO_EVENT), (1, "t", "acme.demo.v1.DemoEnvelope"), (1, "t", DEMO_EVENT)])
    subjects = sorted(r.subject for r in schema_reconcile(c, registry).where("schema_id = 1").collect())
    assert subjects == ["t-acme.demo.v1.DemoEnvelope", "t-acme.demo.v1.DemoEvent"]
