"""Queries over the driver's tables, one for each operator of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprints, langid, lm, mixing, neardup, pii, quality, toxicity, util, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    util.make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitised(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.positions(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), check=True)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_toxicity": op3_toxicity,
        "op4_pii": op4_pii,
        "op5_language_id": op5_language_id,
        "op6_mixing": op6_mixing,
        "op7_bpe": op7_bpe,
        "op8_quality": op8_quality,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_warc": op10_warc,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_language_id": langid.oracle(), "op6_mixing": mixing.ORACLE, "op8_quality": quality.oracle(), "op10_warc": warc.ORACLE}
