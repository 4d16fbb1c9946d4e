"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerloom.llm import alignment, decontamination, line_dedup, packing, pii, search, sharding, simhash, spelling, syncmers, tool_calls, toxicity, url_filter
from ledgerloom.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.detect(table(spark, sf_dir, "documents")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(*tool_calls.from_conversations(table(spark, sf_dir, "conversations")), tool_calls.SCHEMAS)


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.self_search(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_urls(pages))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.digests(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_shard": op2_shard,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_dedup": op6_line_dedup,
    "op7_tool_calls": op7_tool_calls,
    "op8_search": op8_search,
    "op9_url_filter": op9_url_filter,
    "op10_pack": op10_pack,
    "op11_spelling": op11_spelling,
    "op12_syncmers": op12_syncmers,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}
LLM_SQL: dict[str, str] = {
    "op2_shard": sharding.oracle(),
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_tool_calls": tool_calls.ORACLE,
    "op8_search": search.ORACLE,
    "op9_url_filter": url_filter.oracle(),
    "op11_spelling": spelling.ORACLE,
}
