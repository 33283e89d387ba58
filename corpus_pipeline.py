"""The corpus pipeline: what a training corpus goes through, one operator a stage.

Stages that hand texts to Python ask the session for small batches, which hold until the session says otherwise: a stage
runs where its result is written, after it has returned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import bpe_table, curriculum, decision_list, repeat_bytes, set_join
from stationflow.llm.queries import SCHEDULES, table, tokenizer
from stationflow.llm.shared import ask_small_batches, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    ask_small_batches(spark)
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are alike (Jaccard of five-word shingles 0.8 or more) the one with the least id stays.

    Rows are told apart by their texts, so a row with another's id stays if nothing before it is alike. Rows without an id stay.
    """
    ask_small_batches(spark)
    docs = docs.select(*COLUMNS)
    kept = set_join.first_of_each(docs.filter("doc_id IS NOT NULL"), shingle=5, percent=80)
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice or more go, wherever they occur, with any character they cut.

    n_chars counts anew. A document of which no word is left goes.
    """
    ask_small_batches(spark)
    out = repeat_bytes.remove_repeats(docs, length=200, carry=["lang", "source", "n_chars"], as_text=True)
    text = F.when(F.col("n_bytes") > 0, F.col("kept"))
    left = (F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return out.filter(left).select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, in training order, also where its id is null or not its own.

    Rows get a number and are written with it once, so that the mix and the texts name them alike.
    """
    path = f"{shared_folder(spark).rstrip('/')}/mixed-{uuid.uuid4().hex}"
    docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")).write.parquet(path)
    rows, carry = spark.read.parquet(path), ["lang", "n_chars", "_row"]
    mixed = curriculum.mix(rows, SCHEDULES, max_repeats=3, carry=carry)
    takes = curriculum.takes(mixed, SCHEDULES, carry=carry).select("_row", "take", "position")
    return rows.join(takes, "_row").orderBy("position", "doc_id", "take").select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of what they decode to."""
    ask_small_batches(spark)
    path = tokenizer("byte_bpe_50k.json")
    return bpe_table.digests(bpe_table.encode(docs, path, decoded=True), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated bytes", repeated_bytes),
    ("mixed sources", mixed_sources),
    ("bpe", bpe),
]

#: Learned rules, near duplicates of any chain and byte pairs are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to what the one before has written to the shared folder."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
