"""Documents to training text: rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. All but the last return the columns of documents; the last adds the place in
training order. No SQL can state the whole, so tests compare it with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.llm import decontaminate, jaccard_join, line_frequency, line_runs, mixing
from metricloom.llm.storage import discard, read, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that many of their host's have."""
    docs = line_frequency.without_boilerplate(docs.select(*COLUMNS))
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many texts have, but for one text; rows left without a word go."""
    deduped = line_runs.dedup_lines(docs.select(*COLUMNS), keep_first=True)
    deduped = deduped.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return deduped.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    benchmark = read(spark, sf_dir, "benchmark")
    return decontaminate.without_leaks(docs.select(*COLUMNS), benchmark)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in training order."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again; the last one's texts then go."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(last)
    return docs
