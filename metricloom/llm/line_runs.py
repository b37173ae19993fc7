"""Line dedup over levelled, sorted runs of line hashes.

A run holds, sorted by hash, how many documents of some batches have each line.
A new batch is counted, merge-anti-joined with the runs' full lines (those that
already reached the limit need no more counting) and added as a run of level 0.
When a level has `fanout` runs, they are merged into one of the next level. Runs
are bucketed by hash, so these joins and merges read sorted files and shuffle
nothing. A line's hash is 128 bits of two 64-bit hashes. Beside the count a run
has an owner, the least text hash counted so far: the text that may keep the line.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.llm.columns import free_names, let, lower_ascii, without_places
from metricloom.llm.storage import discard, new_folder, stored

STRIPPED = " \t\n\x0b\x0c\r"
LEAST_CHARS = 1
DOCUMENT_LIMIT = 10
BATCHES = 4
FANOUT = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(STRIPPED)))


def hash_of(key: Column) -> Column:
    return F.struct(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")
    )


def key_hashes(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """The hashes of a text's distinct keys."""
    keys = F.filter(
        F.transform(lines_of(text), key_of), lambda k: F.length(k) >= least_chars
    )
    # Distinct by key, which Spark looks up by hash; structs it would compare in pairs.
    return F.transform(F.array_distinct(keys), hash_of)


def placed_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, copy, at, h1, h2): each line with a key that counts, by its place in the text."""
    line = F.transform(
        lines_of(F.col("text")),
        lambda x: let(key_of(x), lambda k: F.when(F.length(k) >= least_chars, hash_of(k))),
    )
    return (
        docs.select(
            F.col("doc_id").alias("id"),
            F.xxhash64("text").alias("copy"),
            F.posexplode(line).alias("at", "h"),
        )
        .where("h is not null")
        .select("id", "copy", "at", "h.h1", "h.h2")
    )


def counted(
    docs: DataFrame, least_chars: int = LEAST_CHARS, copies_once: bool = False, *groups: Column
) -> DataFrame:
    """(groups, h1, h2, documents, owner): in how many documents each line is."""
    copy = F.xxhash64("text")
    documents = F.count_distinct("copy") if copies_once else F.count("*")
    hashes = F.explode(key_hashes(F.col("text"), least_chars)).alias("h")
    rows = docs.select(*groups, copy.alias("copy"), hashes)
    names = [c for c in rows.columns if c not in ("copy", "h")]
    return rows.groupBy(*names, "h.h1", "h.h2").agg(
        documents.alias("documents"), F.min("copy").alias("owner")
    )


class LineRuns:
    """Runs in levels; `limit` is the number of documents at which a line is full.

    With `levels`, the names of stored runs by level, the runs of an earlier session
    are gone on with; `buckets` must be theirs. A run is a file per bucket.
    """

    def __init__(
        self,
        spark: SparkSession,
        limit: int = DOCUMENT_LIMIT,
        fanout: int = FANOUT,
        buckets: int | None = None,
        levels: list[list[str]] | None = None,
    ) -> None:
        self.spark, self.limit, self.fanout = spark, limit, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels = [list(names) for names in levels or []]

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.write.bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", new_folder(self.spark, name))
            .format("parquet")
            .saveAsTable(name)
        )
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        runs = [self.spark.table(n) for n in names]
        if len(runs) == 1:
            return runs[0]
        # One bucket-aligned outer join after another: no run is shuffled again.
        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnsRenamed({"documents": "more", "owner": "other"})
            return a.join(b, ["h1", "h2"], "full").select(
                "h1",
                "h2",
                F.least(
                    F.lit(self.limit).cast("long"),
                    F.coalesce("documents", F.lit(0)) + F.coalesce("more", F.lit(0)),
                ).alias("documents"),
                F.least("owner", "other").alias("owner"),
            )

        return reduce(merge, runs)

    def names(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def add(self, counts: DataFrame) -> None:
        """counts: (h1, h2, documents, owner) of one batch, one row per hash."""
        most = F.lit(self.limit).cast("long")
        fresh = counts.select("h1", "h2", F.least(most, "documents").alias("documents"), "owner")
        # Laid out as the runs are: the anti joins move nothing more, a task writes one bucket.
        fresh = fresh.repartition(self.buckets, "h1", "h2")
        for name in self.names():
            full = self.spark.table(name).where(F.col("documents") >= self.limit)
            fresh = fresh.join(full.select("h1", "h2"), ["h1", "h2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(fresh))
        self.compact()

    def compact(self) -> None:
        """Merges every level that is full into the next one."""
        at = 0
        while at < len(self.levels):
            if len(self.levels[at]) >= self.fanout:
                if at + 1 == len(self.levels):
                    self.levels.append([])
                merged = self._write(self._merged(self.levels[at]))
                old, self.levels[at] = self.levels[at], []
                self.levels[at + 1].append(merged)
                for name in old:
                    self.spark.sql(f"DROP TABLE {name}")
            at += 1

    def full_lines(self) -> DataFrame:
        """Hashes found in `limit` documents or more, over all runs."""
        merged = self._merged(self.names()).where(F.col("documents") >= self.limit)
        return merged.select("h1", "h2", "owner")

    def forget(self) -> None:
        """Drops the runs' names; their files stay in the shared folder like any checkpoint."""
        for name in self.names():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def repeated_lines(
    docs: DataFrame,
    limit: int = DOCUMENT_LIMIT,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    copies_once: bool = False,
) -> DataFrame:
    """(h1, h2, owner) of lines in `limit` documents or more; all of docs, batched by text hash."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("text"), F.lit(batches)).alias("batch")
    counts = stored(counted(docs, least_chars, copies_once, batch), "line-counts")
    runs = LineRuns(spark, limit, fanout)
    for i in range(batches):
        runs.add(counts.where(F.col("batch") == i))
    full = stored(runs.full_lines(), "full-lines")
    runs.forget()
    discard(counts)
    return full


def dedup_lines(
    docs: DataFrame,
    limit: int = DOCUMENT_LIMIT,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    keep_first: bool = False,
) -> DataFrame:
    """docs with repeated lines taken out of text, and n_lines, n_dropped.

    Every row counts as a document, and a repeated line goes from all of them. With
    keep_first exact copies count as one document, and a line's owner (a text and
    its copies) keeps it, so that no line is lost. A null or empty text is one
    empty line, which is never dropped; its kept text is empty. Null ids, repeated
    rows and further columns stay as they are (columns called n_lines or n_dropped
    are replaced). Lines are dropped by their places, so a text's cost grows with its
    lines alone. Texts move once, by id, to meet the list of their own places.
    """
    full = repeated_lines(docs, limit, least_chars, batches, fanout, copies_once=keep_first)
    own = placed_hashes(docs, least_chars).join(full, ["h1", "h2"])
    if keep_first:
        own = own.where("owner <> copy")
    plain = docs.drop("n_lines", "n_dropped")
    # A set: rows that repeat a document bring the same places again.
    mark, of_id, of_copy, cut = free_names(
        [*plain.columns, "left", "n_lines", "n_dropped"], "copy", "of_id", "of_copy", "cut"
    )
    own = own.groupBy(F.col("id").alias(of_id), F.col("copy").alias(of_copy)).agg(
        F.collect_set("at").alias(cut)
    )
    keyed = plain.withColumn(mark, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(own[of_id]) & (keyed[mark] == own[of_copy])
    columns = [F.col(f"`{c}`") for c in plain.columns if c != "text"]
    lines = lines_of(F.col("text"))
    left = F.when(F.col(cut).isNull(), lines).otherwise(
        let(lines, lambda ls: without_places(ls, F.col(cut)))
    )
    done = keyed.join(own, same, "left").select(
        F.struct(*columns).alias("row") if columns else F.lit(None).alias("row"),
        left.alias("left"),
        F.size(lines).cast("long").alias("n_lines"),
    )
    return done.select(
        *[F.col("row").getField(c).alias(c) for c in plain.columns if c != "text"],
        F.array_join("left", "\n").alias("text"),
        "n_lines",
        (F.col("n_lines") - F.size("left")).alias("n_dropped"),
    )


def dedup_report(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )
