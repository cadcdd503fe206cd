"""Places of rows within their groups, without a task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import written

_INDEX_BITS = 33  # of monotonically_increasing_id: the row's index in its partition


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows``, written in the order of ``group`` and ``order`` (no nulls in
    ``group``; nulls first in ``order``), with ``part`` and ``index``, and the
    table of pieces that makes places of them: per ``group`` and ``part`` the
    ``shift`` to add to ``index`` for the place in the group, from 0, and the
    group's ``size``. Rows are dealt by ranges, equal ones too, so a group of
    any size is many tasks; the pieces are one row per group and task."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, F.col("_tie"))
    spread = spread.sortWithinPartitions(*keys, "_tie").drop("_tie").withColumn("_id", F.monotonically_increasing_id())
    index = F.col("_id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    placed = written(spread.withColumn("part", F.shiftright("_id", _INDEX_BITS)).withColumn("index", index).drop("_id"), name)
    pieces = placed.groupBy(*group, "part").agg(F.min("index").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed, pieces.select(*group, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))


def with_places(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``at``, the place in the group, and ``size``, the group's."""
    placed, pieces = ranked(rows, group, order, name)
    return placed.join(pieces, [*group, "part"]).withColumn("at", F.col("index") + F.col("shift")).drop("part", "index", "shift")
