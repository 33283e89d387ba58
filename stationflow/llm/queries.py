"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_table, curriculum, decision_list, interpolation, level_windows, licence_text, prefix_trie, repeat_bytes, set_join, shared_terms, simhash, url_model, weak_toxicity
from .oracles import ORACLES
from .shared import saved

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def tokenizer(name: str) -> str:
    """A vocabulary file: in the folder that TOKENIZERS_DIR names, or where the installed package has it."""
    if "TOKENIZERS_DIR" in os.environ:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


#: Of the sources of weight 1, 2 and 3: from more to less, even, from less to more. Each integral is the weight.
SCHEDULES = [
    [(0.0, 1.5), (1.0, 0.5)],
    [(0.0, 2.0), (1.0, 2.0)],
    [(0.0, 1.5), (0.5, 3.0), (1.0, 4.5)],
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"), SCHEDULES, max_repeats=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    judged = decision_list.judge(docs, rules)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.join_sets(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeat_bytes.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = level_windows.remove_repeats(table(spark, sf_dir, "documents"), length=20, first=5)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With n_close: of every document whose id is divisible by 20, other documents within 3 bits of its fingerprint."""
    out = simhash.compare_with_edits(table(spark, sf_dir, "documents"))
    have = out.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("documents"))
    close = simhash.within_radius(out.filter("doc_id % 20 = 0"), have, radius=3)
    counts = close.join(have.withColumnRenamed("fingerprint", "other"), "other").groupBy("fingerprint").agg((F.sum("documents") - 1).alias("n_close"))
    return out.join(counts, "fingerprint", "left").withColumn("n_close", F.when(F.col("doc_id") % 20 == 0, F.col("n_close")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    return bpe_table.digests(bpe_table.encode(table(spark, sf_dir, "documents"), path, decoded=True))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = licence_text.matches(docs)
    return licence_text.of_documents(docs, licence_text.scan(docs, licence_text.fit(docs, matched=matched), matched=matched))


RULES = [
    url_model.Rule("com", "/", "allow"),
    url_model.Rule("example.com", "/en/", "block"),
    url_model.Rule("www.example.com", "/en/", "allow"),
    url_model.Rule("net", "/es/", "block"),
    url_model.Rule("net", "/fr/", "block"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judge(table(spark, sf_dir, "pages"), RULES)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_toxicity.score(docs, weak_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = saved(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    rebuilt, ids = prefix_trie.with_shared_heads(turns)
    found = prefix_trie.trie(saved(rebuilt), ids)
    out = found.nodes.join(found.end_digests(), prefix_trie.NAME, "left").fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = interpolation.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_terms.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=10)


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_repeated_bytes": op4_repeated_bytes,
    "op5_repeated_words": op5_repeated_words,
    "op6_fingerprints": op6_fingerprints,
    "op7_bpe": op7_bpe,
    "op8_licences": op8_licences,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lm_score": op12_lm_score,
    "op13_search": op13_search,
}
