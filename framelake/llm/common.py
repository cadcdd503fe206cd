"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.session import scratch_path, ship_package

# The word class of most contracts: runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"
GAP_RE = r"[\x20\x09-\x0D]+"
GAP_CHARS = "concat(' ', char(9), char(10), char(11), char(12), char(13))"  # SQL string of the same characters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the
    lineage at a table that outlives lost executors, and runs ``df`` once."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spent_tables_removed(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and nothing reads again: their
    folders, each a fresh one, and no other."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            parent, _, name = folder.rpartition("/")
            if not (name.startswith("llm-") and parent.endswith("/framelake")):
                raise ValueError(f"not a table of written(): {folder}")
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def spent_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes a query's shuffle files when the query ends
    (from Spark 4.1), not when the driver's JVM happens to collect garbage: for
    a run of ``written`` tables, whose shuffles nothing reads again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def python_ready(df: DataFrame) -> DataFrame:
    """``df``, with this package importable in its Python workers."""
    ship_package(df.sparkSession)
    return df


def id_keys() -> list[Column]:
    """``doc_id`` as two columns ``id_key`` and ``no_id`` that are never null:
    joins and windows on them can share one shuffle, which a null-safe join and
    a window on ``doc_id`` itself do not."""
    doc_id = F.col("doc_id")
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("id_key"), doc_id.isNull().alias("no_id")]


def text_hash(text: Column | str) -> Column:
    """64-bit key of a text (null and empty alike), so that rows of equal
    ``doc_id`` but different texts stay apart in joins."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))

