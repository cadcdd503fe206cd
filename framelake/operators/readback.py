"""Reading the target table back (SRC-3, SRT-1, SRT-2, CAT-1..CAT-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default read-back sizes.
DEFAULT_LATEST_LIMIT = 50
DEFAULT_SAMPLE_LIMIT = 10
# Unique tie-break after ingested_at, which is constant within a micro-batch.
DEFAULT_TIE_BREAK = ("offset", "partition", "topic")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-3: a catalog table by its (catalog.namespace.table) name. The
    table is refreshed first: a streaming writer commits through its own
    session, so this session's cached file listing may be stale."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def latest_rows(
    table: DataFrame,
    n: int = DEFAULT_LATEST_LIMIT,
    order_by: str = "ingested_at",
    tie_break: Sequence[str] = DEFAULT_TIE_BREAK,
) -> DataFrame:
    """SRT-1: ``ORDER BY ingested_at DESC LIMIT n`` with a deterministic
    tie-break (planned as a top-k: each task keeps n rows)."""
    keys = [F.col(order_by).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break if c in table.columns]
    return table.orderBy(*keys).limit(n)


def latest_table_rows(
    spark: SparkSession,
    name: str,
    n: int = DEFAULT_LATEST_LIMIT,
    order_by: str = "ingested_at",
    tie_break: Sequence[str] = DEFAULT_TIE_BREAK,
    partition_columns: Sequence[str] = ("run_id", "batch_id"),
) -> DataFrame:
    """SRT-1 for a table partitioned by micro-batch, in two phases of one
    plan: the top-n over the ordering and partition columns only (a narrow
    scan), then the same top-n over just the partitions that hold them. Their
    names, n at most, are broadcast, and prune the wide scan at run time.
    Other tables fall back to ``latest_rows``."""
    table = read_table(spark, name)
    if not all(c in table.columns for c in partition_columns):
        return latest_rows(table, n, order_by, tie_break)
    keys = [order_by, *[c for c in tie_break if c in table.columns]]
    top = latest_rows(table.select(*dict.fromkeys(keys + list(partition_columns))), n, order_by, tie_break)
    holding = top.select(*partition_columns).distinct()
    return latest_rows(table.join(F.broadcast(holding), list(partition_columns), "left_semi"), n, order_by, tie_break)


def latest_rows_sql(spark: SparkSession, name: str, n: int = DEFAULT_LATEST_LIMIT) -> DataFrame:
    """SRT-1 as the SQL statement the read-back job runs."""
    return spark.sql(f"SELECT * FROM {name} ORDER BY ingested_at DESC LIMIT {int(n)}")


def contract_view(spark: SparkSession, name: str, view: str) -> DataFrame:
    """The target's three-column contract ``(id, payload, ingested_at)`` as a
    temporary view over a table that also carries lineage and batch columns."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT id, payload, ingested_at FROM {name}")
    return spark.table(view)


def sample_rows(table: DataFrame, n: int = DEFAULT_SAMPLE_LIMIT) -> DataFrame:
    """SRT-2: any n rows (``SELECT * ... LIMIT n``), stops reading early."""
    return table.limit(n)


def list_catalogs(spark: SparkSession) -> DataFrame:
    """CAT-1 (lists catalogs already loaded in the session)."""
    return spark.sql("SHOW CATALOGS")


def list_namespaces(spark: SparkSession, catalog: str) -> DataFrame:
    """CAT-2."""
    return spark.sql(f"SHOW NAMESPACES IN {catalog}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """CAT-3 (``namespace`` may be catalog-qualified)."""
    return spark.sql(f"SHOW TABLES IN {namespace}")
