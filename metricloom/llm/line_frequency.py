"""Quality rules: repetition inside a text, and lines that many documents of a host share.

A line is normalised (ends stripped, white space runs made one space, A-Z in lower
case) and hashed to 128 bits. Per host the distinct documents with a line are
counted; exact copies are one document, so a popular text does not count against
itself. Lines above the limit are taken out, and a document left with too small
a share of its words is rejected as depleted. Counts and hashes are shuffled, texts
never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricloom.llm.columns import SPACE, free_names, let, lower_ascii, total, without_places, words_of
from metricloom.llm.storage import stored

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

# A line is boilerplate in a host, whatever its size, if more documents than this have it.
LINE_DOCUMENTS = 10
# Depleted: boilerplate holds more than this share of the words.
DEPLETED_PERCENT = 75


def normalised(line: Column) -> Column:
    return lower_ascii(F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE + "+", " "))


def _hash(value: Column) -> Column:
    return F.struct(
        F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("second"), value).alias("h2")
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of words found twice or more in the list."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda s, j: F.least(
                F.lit(window), F.coalesce(F.get(starts, j + 1) - s, F.lit(window))
            ),
        )
        return total(steps)

    def marked(windows: Column) -> Column:
        order = F.array_sort(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def starts(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        return let(let(order, starts), covered)

    def counted(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - window + 1),
            lambda i: F.xxhash64(F.slice(hashes, i, window)),
        )
        several = let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), marked(w)).otherwise(
                F.lit(0).cast("long")
            ),
        )
        return F.when(F.size(hashes) >= window, several).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds the base rules' counts to (doc_id, text, ...), row by row."""
    text = F.coalesce("text", F.lit(""))
    spoken = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (
        docs.withColumn(
            "measured",
            let(
                words_of(text),
                lambda w: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    repeated_words(w).alias("n_repeat_words"),
                ),
            ),
        )
        .withColumn(
            "n_dup_lines",
            let(spoken, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")),
        )
        .withColumn("word_chars", F.length(F.translate(text, SPACES, "")).cast("long"))
        .withColumn(
            "n_symbols",
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        )
        .select("*", "measured.n_words", "measured.n_repeat_words")
        .drop("measured")
        .withColumn(
            "base_failed",
            (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words),
        )
    )


def spoken_lines(docs: DataFrame) -> DataFrame:
    """(id, host, copy, at, h1, h2, words): each line with a word."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), normalised)
    described = F.transform(
        lines,
        lambda line: F.struct(
            _hash(line).alias("h"),
            F.when(line != "", F.size(F.split(line, " "))).otherwise(0).alias("words"),
        ),
    )
    return (
        docs.select(
            F.col("doc_id").alias("id"),
            F.coalesce("source", F.lit("")).alias("host"),
            F.xxhash64("text").alias("copy"),
            F.posexplode(described).alias("at", "line"),
        )
        .where("line.words > 0")
        .select("id", "host", "copy", "at", "line.h.h1", "line.h.h2", "line.words")
    )


def boilerplate(docs: DataFrame, line_documents: int = LINE_DOCUMENTS) -> DataFrame:
    """(host, h1, h2) of the lines above the limit."""
    return (
        spoken_lines(docs)
        .groupBy("host", "h1", "h2")
        .agg(F.count_distinct("copy").alias("documents"))
        .where(F.col("documents") > line_documents)
        .select("host", "h1", "h2")
    )


def _judged(docs: DataFrame, line_documents: int, depleted_percent: float) -> DataFrame:
    """The columns of judge, and cut: the places of the boilerplate lines, null without any."""
    docs = docs.select("doc_id", "text", "source")
    removed = (
        spoken_lines(docs)
        .join(boilerplate(docs, line_documents), ["host", "h1", "h2"])
        .groupBy("id", "host", "copy")
        # A set: rows that repeat a document bring the same lines again.
        .agg(F.collect_set(F.struct("at", "words")).alias("lines"))
        .select(
            "id",
            "host",
            "copy",
            total(F.transform("lines", lambda x: x["words"].cast("long"))).alias("gone"),
            F.transform("lines", lambda x: x["at"]).alias("cut"),
        )
    )
    rows = base_counts(docs).select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("of_host"),
        F.xxhash64("text").alias("of_copy"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.xxhash64("doc_id", "text", "source").alias("key"),
    )
    gone = F.coalesce("gone", F.lit(0).cast("long"))
    return rows.join(
        removed,
        rows["doc_id"].eqNullSafe(removed["id"])
        & (rows["of_host"] == removed["host"])
        & (rows["of_copy"] == removed["copy"]),
        "left",
    ).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (100 * gone <= depleted_percent * F.col("n_words"))).alias("kept"),
        gone.alias("n_boilerplate_words"),
        "key",
        "cut",
    )


def judge(
    docs: DataFrame,
    line_documents: int = LINE_DOCUMENTS,
    depleted_percent: float = DEPLETED_PERCENT,
) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, n_boilerplate_words and key.

    key is a hash of id, text and source, for joining back to docs.

    `source` is the host; a null source is the host without a name. A null or
    empty text has no words and fails the base rules. Null ids and repeated rows
    stay rows of their own; other columns are left out.
    """
    return _judged(docs, line_documents, depleted_percent).drop("cut")


def without_boilerplate(
    docs: DataFrame,
    line_documents: int = LINE_DOCUMENTS,
    depleted_percent: float = DEPLETED_PERCENT,
) -> DataFrame:
    """The rows of docs that judge keeps, their texts without the boilerplate lines.

    Only marks of rows that change or go are joined back; other columns stay as they are.
    """
    key, kept, cut = free_names(docs.columns, "key", "kept", "cut")
    marks = (
        _judged(docs, line_documents, depleted_percent)
        .where("not kept or cut is not null")
        .select(F.col("key").alias(key), F.col("kept").alias(kept), F.col("cut").alias(cut))
        .dropDuplicates([key])
    )
    left = let(F.split("text", "\n", -1), lambda lines: without_places(lines, F.col(cut)))
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return (
        docs.withColumn(key, F.xxhash64("doc_id", "text", "source"))
        .join(stored(marks, "marks"), key, "left")
        .where(F.coalesce(kept, F.lit(True)))
        .select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    )
