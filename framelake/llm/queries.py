"""The registered queries of this subpackage, and the SQL of their results."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import oracles
from framelake.llm.chat import formatted_digests
from framelake.llm.common import table
from framelake.llm.decontaminate import mark
from framelake.llm.line_dedup import duplicate_lines
from framelake.llm.merkle import FIELDS, leaf_digest, manifest, proof_digest
from framelake.llm.minhash_dedup import near_duplicates as minhash_duplicates
from framelake.llm.mixing import mix_plan
from framelake.llm.prefix_trie import prefix_trie
from framelake.llm.quality import judge
from framelake.llm.secrets import KINDS, METHOD_KIND, find_secrets
from framelake.llm.simhash_dedup import near_duplicates
from framelake.llm.token_codes import token_index
from framelake.llm.toxicity import score_toxicity
from framelake.llm.url_filter import judge_urls, rule_table

END_ID = 2
PROBE = "</s>[INST] ok [/INST]"  # a conversation that says control strings
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _span_list(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, METHOD_KIND)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_span_list("base"), 256).alias("base_sha256"), _span_list("spans").alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicate_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = F.array(*[F.struct(F.lit(-1), F.lit(turn), F.lit(role), F.lit(PROBE)) for turn, role in enumerate(("user", "assistant"))])
    probe = spark.range(1).select(F.inline(turns.cast(f"array<{given.schema.simpleString()}>")))
    return formatted_digests(given.unionByName(probe), public_tokenizers.path("byte_bpe_50k.json"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), carry=["doc_id"])  # the result needs no texts
    return judged.select("row.doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "kept")


def word_tokenizer() -> str:
    """Place of the vocabulary file, which every machine's Python installation has."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"), word_tokenizer(), END_ID)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    marked = mark(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256")
    )
    return marked.withColumn("contaminated", F.col("n_hit") > 0)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_duplicates(table(spark, sf_dir, "documents")).drop("hash")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, checked against rows a third of which have their letters lowered."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    shown = F.when(hit, leaf_digest(*[lowered if c == "text" else F.col(c) for c in FIELDS]))
    rows = proof_digest(manifest(table(spark, sf_dir, "documents"), shown))
    digits = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return rows.select("doc_id", *digits, F.col("proof").alias("proof_sha256"), F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_line_dedup": op2_line_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_url_filter": op4_url_filter,
    "op5_token_codes": op5_token_codes,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_source_mix": op8_source_mix,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_minhash": op12_minhash,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL: dict[str, str] = {"op3_chat_format": oracles.OP3, "op4_url_filter": oracles.OP4, "op6_decontaminate": oracles.OP6, "op8_source_mix": oracles.OP8, "op9_quality_rules": oracles.OP9, "op11_prefix_trie": oracles.OP11, "op12_minhash": oracles.OP12, "op13_merkle_manifest": oracles.OP13}
