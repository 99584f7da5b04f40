"""Registered queries of this subpackage, each over its whole table, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import flatfiles, language, licenses, merkle, mixing, packing, pages, quality, repeats, runs, simhash, surrogates, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(oracle: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn
    return deco


@register(quality.ORACLE)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(C.table(spark, sf_dir, "documents"))


@register(licenses.ORACLE)
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(C.table(spark, sf_dir, "documents"))


@register()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(C.table(spark, sf_dir, "documents"))


@register()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(C.table(spark, sf_dir, "documents"))


@register(mixing.ORACLE)
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(C.table(spark, sf_dir, "documents"))


@register()
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_mixture(C.table(spark, sf_dir, "documents"))


@register(topk.ORACLE)
def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatfiles.token_counts(C.table(spark, sf_dir, "documents"))


@register()
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_personal_data(C.table(spark, sf_dir, "documents"))


@register()
def op8_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(C.table(spark, sf_dir, "documents"))


@register()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.planted(C.table(spark, sf_dir, "documents"))))


@register()
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return merkle.verify(docs, merkle.lowered(docs))


@register()
def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(C.table(spark, sf_dir, "pages"))
