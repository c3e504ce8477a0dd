"""Queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from waybill.llm import (
    decontamination,
    fill_in_middle,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    merkle,
    mixing,
    multi_index,
    pii,
    suffix_dedup,
    url_filter,
    warc,
)
from waybill.llm.storage import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_line_dedup", line_dedup.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.digest(line_dedup.rewritten(line_dedup.store_of(docs), docs))


@query("op10_warc", warc.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.read(warc.write(table(spark, sf_dir, "pages")), payloads=False))


@query("op8_decontamination", decontamination.SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.license_scan(table(spark, sf_dir, "documents"))[0])


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.digest(language_id.language_id(docs, columns=["doc_id"]))


@query("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id"]))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).select("row.doc_id", "n_found", "kinds", "text")


@query("op1_near_embeddings", multi_index.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.suffix_dedup(
        table(spark, sf_dir, "documents"), keep="none", texts=False))


@query("op3_jaccard_join", jaccard_join.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op11_url_filter", url_filter.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(url_filter.judge(
        table(spark, sf_dir, "pages").select("page_id", "url")))


@query("op12_fill_in_middle", fill_in_middle.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle.digest(fill_in_middle.transform(docs))


@query("op13_merkle_manifest", merkle.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
