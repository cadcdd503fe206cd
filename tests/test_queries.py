"""Every registered query against its DuckDB statement, on sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracles import TABLES, digest  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from framelake.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows, name  # rows-only check
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["topic", "partition", "offset", "timestamp", "key", "id", "payload"]


def test_filtered_decode_reads_and_decodes_only_what_it_keeps(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the list is cut off
    plan = entry.queries()["decoded_payload_filtered"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "EqualTo(partition,1)" in pushed and "GreaterThanOrEqual(timestamp" in pushed
    assert plan.index("ArrowEvalPython") < plan.index("Filter")  # the filter runs below the decode


def test_quarantine_decodes_once(spark):
    plan = entry.queries()["quarantine"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
