"""Mixing sources to target weights by systematic sampling.

Sources share a target number of words by weight; a source's target stops at
``MAX_COPIES`` times its own words and the excess goes to the others by weight.
Within a source every document expects target / size copies. The expected
copies are summed up in the order of document size (ties in a hashed order of
``doc_id``), one random offset of the source is added, and a document is
emitted once for each integer boundary that its step crosses. The order by
size makes the draw a stratified one, so taken words stay within about one long
document of the target.

The prefix sums need each document's rank in its source. A source may hold a
third of all rows, so ranks are put together from counts: documents of smaller
sizes (a sum over distinct sizes), of the same size in earlier hash buckets (a
sum over at most 4096 buckets), and of the same bucket (a window over a
1/4096th of equal-sized documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import WORD_RE, id_keys, text_hash, written

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order of code point, null last, over and over
SHARE = 1.5  # target words of all sources, times their words
MAX_COPIES = 2.0
SEED = 17
BUCKET_DIGITS = 3  # hex digits of the hash that name a bucket


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES) -> DataFrame:
    """``source, docs, source_size, target`` from rows ``source, size``.

    Filling all sources up to a common level (words per weight), a source is
    full when its stop divided by its weight lies below that level. Sorted by
    that quotient the full sources come first, so one pass over the source
    totals finds them; only those totals go through the unpartitioned windows.
    """
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(order, F.lit(len(weights))) + 1).cast("int"))
    stop = F.col("source_size") * F.lit(max_copies)
    level = totals.withColumn("weight", weight).withColumn("stop", stop).withColumn("quotient", F.col("stop") / F.col("weight"))
    by_level = Window.orderBy("quotient", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = level.select(
        "*",
        F.coalesce(F.sum("stop").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("words"),
    ).withColumn("full", F.col("before") + F.col("quotient") * F.col("open") <= F.col("words"))
    rest = F.col("words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("stop"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return filled.select("source", "docs", "source_size", F.when(F.col("full"), F.col("stop")).otherwise(rest * F.col("weight") / open_weight).alias("target"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, hash, size``: size in words, 0 for a null text."""
    return docs.select("doc_id", "source", text_hash("text").alias("hash"), F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # a null source groups and joins like any other


def mix_plan(docs: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """``doc_id, source, hash, size, source_size, target, copies`` for each row
    of ``docs`` (columns ``doc_id, text, source``; others are not read).

    ``copies`` is 0, 1 or 2 and the same in every run. Null texts have size 0;
    a null source is one more source, ordered last; null ``doc_id``s are
    ordered like an empty one. Rows equal in these columns are told apart only
    by rank, so which of them gets a copy does not matter. If no document has
    a word, all targets are 0 and nothing is emitted.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = written(document_sizes(docs).withColumn("key", _source_key(F.col("source"))).withColumn("digest", digest).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS)), "mix-sizes")
    targets = source_targets(sized, **shares).withColumn("key", _source_key(F.col("source"))).drop("source")
    up_to = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    in_bucket = sized.groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    in_size = in_bucket.groupBy("key", "size").agg(F.sum("n").alias("n"))
    in_size = in_size.select("key", "size", F.coalesce(F.sum("n").over(up_to("key").orderBy("size")), F.lit(0)).alias("smaller"))
    in_bucket = in_bucket.select("key", "size", "bucket", F.coalesce(F.sum("n").over(up_to("key", "size").orderBy("bucket")), F.lit(0)).alias("earlier"))
    before = in_bucket.join(in_size, ["key", "size"]).select("key", "size", "bucket", (F.col("smaller") + F.col("earlier")).alias("before"))
    own = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("digest", "hash"))
    ranked = sized.withColumn("own", own).join(before, ["key", "size", "bucket"])
    rank = F.col("before") + F.col("own")
    # Multiples of 2^-28: exact in a double beside any rank.
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("key"))), 1, 7), 16, 10).cast("double") / F.lit(float(1 << 28))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(rank * F.col("expected") + offset) - F.floor((rank - 1) * F.col("expected") + offset)
    planned = ranked.join(targets.withColumn("expected", expected), "key")
    return planned.select("doc_id", "source", "hash", "size", "source_size", "target", F.least(crossed, F.ceil("expected")).alias("copies"))


def mix(docs: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as
    ``mix_plan`` says. Rows equal in ``doc_id``, source and text share their
    copies in turn, by the hash of all their columns, so reruns emit the same rows."""
    keys = ["id_key", "no_id", "key", "hash"]
    plan = mix_plan(docs, seed, **shares).select(*id_keys(), _source_key(F.col("source")).alias("key"), "hash", "copies")
    plan = plan.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where(F.col("copies") > 0)
    packed = docs.select(F.struct("*").alias("row"), *id_keys(), _source_key(F.col("source")).alias("key"), text_hash("text").alias("hash"))
    met = packed.join(plan, keys)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row")))
    share = lambda k: F.floor(F.col("copies") * k / F.col("rows"))
    dealt = met.withColumn("turn", turn).withColumn("n", (share(F.col("turn")) - share(F.col("turn") - 1)).cast("int"))
    return dealt.where(F.col("n") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("row.*")
