"""The registered queries of this folder, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from metricloom.llm import (
    bpe,
    decontaminate,
    html_wrappers,
    jaccard_join,
    lexical_search,
    license_scan,
    line_frequency,
    line_runs,
    mixing,
    secret_scan,
    token_alignment,
    url_rules,
    warc,
)
from metricloom.llm.oracle import ORACLE  # noqa: F401  read by the entry point
from metricloom.llm.storage import read

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


@query
def op1_secret_scan(spark, folder):
    return secret_scan.secret_report(read(spark, folder, "documents"))


@query
def op2_quality_rules(spark, folder):
    return line_frequency.judge(read(spark, folder, "documents")).drop("key")


@query
def op3_license_scan(spark, folder):
    return license_scan.scan_licenses(read(spark, folder, "documents"))


@query
def op4_line_dedup(spark, folder):
    return line_runs.dedup_report(read(spark, folder, "documents"))


@query
def op5_jaccard_join(spark, folder):
    return jaccard_join.near_duplicates(read(spark, folder, "documents")).drop("r")


@query
def op6_source_mixing(spark, folder):
    return mixing.mix_report(read(spark, folder, "documents"))


@query
def op7_decontamination(spark, folder):
    documents, benchmark = (read(spark, folder, t) for t in ("documents", "benchmark"))
    return decontaminate.find_leaks(documents, benchmark)


@query
def op8_html_extraction(spark, folder):
    return html_wrappers.extract_text(read(spark, folder, "pages"))


@query
def op9_url_filter(spark, folder):
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    return url_rules.filter_urls(read(spark, folder, "pages"), rules)


@query
def op10_warc_round_trip(spark, folder):
    return warc.round_trip(read(spark, folder, "pages"))


@query
def op11_bpe_round_trip(spark, folder):
    own = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.report(read(spark, folder, "documents"), own)


@query
def op12_token_alignment(spark, folder):
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.report(read(spark, folder, "documents"), token_alignment.pair(*paths))


@query
def op13_lexical_search(spark, folder):
    documents, benchmark = (read(spark, folder, t) for t in ("documents", "benchmark"))
    return lexical_search.search(documents, benchmark)
