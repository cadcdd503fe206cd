"""URL filter: a blocked Bloom filter of the listed canonical URLs lets through
possible hits, an exact hash join removes its false positives.

A list entry is a host and a path prefix; it fits that host and its subdomains
where the page's path starts with the prefix, and the longest entry wins. Its
canonical form is ``host || path``. A page is looked up under every canonical
form that could list it: each host suffix of as many labels, and each path
prefix of as many characters, as some entry has. Those numbers are read off
the list (one integer per distinct label count or prefix length).

The filter is in ``bloom``; its broadcast has a fixed bound.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.bloom import bloom_blocks, possible_hits

ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null or for a URL without ``://``."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty as above."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` entries as a list table, without Python workers."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``
    (columns ``page_id`` and ``url``; others are not read).

    ``rule`` is the longest fitting entry of ``rules`` (``host, path,
    verdict``), or null, and ``verdict`` that entry's, or ``default`` for a
    page that the list does not hold. A null URL, or one without ``://``, has
    empty host and path and fits nothing; repeated rows are judged alike and
    all returned; of entries with equal host and path the least verdict counts;
    entries with a null are ignored. Empty tables give empty results or
    defaults.

    The distinct (host, path) pairs are judged once, so that a host or a URL
    with a third of the rows costs one lookup; the join that brings the
    verdicts back is on both columns, and adaptive execution splits it where
    one pair is hot.
    """
    listed = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .select(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("key", F.concat("host", "path"))
    )
    shapes = listed.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    located = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shapes:
        return located.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    forms = [
        F.when(
            (F.col("labels") >= labels) & (F.length("path") >= chars),
            F.concat(F.substring_index("host", ".", -labels), F.substring(F.col("path"), F.lit(1), F.lit(chars))),
        )
        for labels, chars in sorted((s["labels"], s["chars"]) for s in shapes)
    ]
    candidates = (
        located.where(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .withColumn("labels", _labels(F.col("host")))
        .select("host", "path", F.explode(F.array_compact(F.array(*forms))).alias("key"))
    )
    fits = possible_hits(candidates, bloom_blocks(listed)).join(listed.select("key", "verdict"), "key")
    # The longest key of a pair is its longest rule; no two fitting rules of one length differ.
    longest = fits.groupBy("host", "path").agg(F.max(F.length("key")).alias("chars")).withColumnsRenamed({"host": "h", "path": "p"})
    judged = fits.join(longest, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")) & (F.length("key") == F.col("chars")))
    judged = judged.groupBy("host", "path").agg(F.max("key").alias("rule"), F.max_by("verdict", "key").alias("verdict"))
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    return located.join(judged, ["host", "path"], "left").select("page_id", "host", "path", "rule", verdict)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
