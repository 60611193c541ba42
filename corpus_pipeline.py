"""The corpus pipeline: documents through five stages to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; ``run`` writes each result as
Parquet to the shared folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statloom.llm import bpe, mixing, neardup, pii, toxicity, util


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. Null and empty texts, and all documents where there are no labels, stay; rows
    that repeat are judged alike; other columns pass untouched; an empty table stays empty."""
    util.make_importable(spark)
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id. Rows without doc_id or text all stay;
    of rows with one doc_id and one text the first as JSON stays; empty texts are copies of each other."""
    return neardup.deduplicate(docs)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers and what reveals them are replaced; every row stays. Null and empty texts stay as they are, rows that
    repeat give rows that repeat, n_chars follows the text."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is used at least once, short sources again, in the order of training positions. A null source is a
    source of its own; null and empty texts have no tokens and keep their turn; rows that repeat count each."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids of every row; null texts have null tokens, empty ones none. This stage comes after
    mixing, so documents that mixing repeats are encoded as often as they are used."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("personal_data", personal_data_out),
    ("mixing", mixed),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = util.saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
