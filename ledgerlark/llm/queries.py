"""The queries of this subpackage and their SQL: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import flac, fmindex, gam, langid, license_scan, merkle, mixing, packing, simhash, sql, suffix
from ledgerlark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return gam.score(docs, gam.train(docs, read(spark, sf_dir, "labels")))


def op2_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.dedup_digest(read(spark, sf_dir, "documents"))


def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(read(spark, sf_dir, "documents"))


def op4_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_digest(read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op6_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_digest(read(spark, sf_dir, "documents"))


def op7_language_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_digest(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    every = (op1_quality_gam, op2_fm_substring_dedup, op3_merkle_fingerprints, op4_simhash_bk_trees, op5_license_scan, op6_flac_media, op7_language_mixtures, op8_packing, op9_mixing, op10_suffix_array_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
