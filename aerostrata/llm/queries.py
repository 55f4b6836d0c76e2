"""The corpus operators' queries, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bagminhash, decontam, imatch, langid, lm, mixing, quality, repeats, tokenstore, toxicity
from .common import stage_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": lambda spark, d: langid.identify(table(spark, d, "pages"), table(spark, d, "documents")),
    "op2_lm_difference": lambda spark, d: lm.score(table(spark, d, "documents"), lm.good_documents(table(spark, d, "labels"))),
    "op3_decontamination": lambda spark, d: decontam.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_quality": lambda spark, d: quality.quality(table(spark, d, "documents"), table(spark, d, "labels")),
    "op5_imatch": lambda spark, d: imatch.fingerprint_documents(table(spark, d, "documents")),
    "op6_near_duplicates": lambda spark, d: bagminhash.near_classes(table(spark, d, "documents")),
    "op7_mixing": lambda spark, d: mixing.mix_counts(table(spark, d, "documents")),
    "op8_repeats": lambda spark, d: repeats.without_repeats(table(spark, d, "documents")),
    "op9_toxicity": lambda spark, d: toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_token_store": lambda spark, d: tokenstore.store_and_read(table(spark, d, "documents"), stage_path(spark, "token-store")),
}
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": decontam.ORACLE_SQL,
    "op7_mixing": mixing.oracle_sql(),
}
