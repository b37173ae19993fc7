"""CSV whose quoted values hold line ends, read by many tasks.

Files are read line by line in blocks, as Spark cuts them. A line starts a record if
an even number of quotes stands before it in its file: blocks are summed first (a row
per block), so each block knows the parity it starts with, and a running sum over its
own lines gives theirs. Records of one line, nearly all, are parsed where they are;
only the lines of longer records are brought together, by their record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricloom.sources import quarantine

OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
BLOCK = ["file", "block"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value, quotes): each line; `at` orders the lines of a block."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
            F.length(F.regexp_replace("value", '[^"]', "")).alias("quotes"),
        )
    )


def starts(placed: DataFrame) -> DataFrame:
    """(file, block, odd): whether a block starts inside quotes. A file that ends inside some fails."""
    blocks = placed.groupBy(*BLOCK).agg(F.sum("quotes").alias("quotes"))
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed in "), "file"))
    return blocks.select(
        *BLOCK,
        F.when(F.sum("quotes").over(file) % 2 == 1, unclosed.cast("long"))
        .otherwise(F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
        .alias("odd"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record): each record's text, without the line end after it.

    `first` marks the first record of a file. Blank lines outside quotes are left out.
    A lost carriage return is none: one inside quotes stays, one before a line end
    outside goes with it.
    """
    placed = lines(spark, path)
    block = Window.partitionBy(*BLOCK).orderBy("at")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    after = (F.col("odd") + F.sum("quotes").over(so_far)) % 2 == 1
    marked = (
        placed.join(starts(placed), BLOCK)
        .withColumn("open", after)
        .withColumn("inside", F.col("open") != (F.col("quotes") % 2 == 1))
        .withColumn("first", (F.col("block") == 0) & (F.row_number().over(block) == 1))
        .withColumn(
            "head", F.last(F.when(~F.col("inside") & F.col("open"), F.col("at")), True).over(so_far)
        )
    )
    text = F.regexp_replace("value", "\r$", "")
    single = marked.where("not inside and not open").select("first", text.alias("record"))

    parts = marked.where("inside or open")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.col("head").isNotNull(), F.struct("block", "head"))
    # A line before its block's first head belongs to the last head of the blocks before.
    carried = (
        parts.groupBy(*BLOCK)
        .agg(F.max("head").alias("head"))
        .select(*BLOCK, F.last(last, True).over(earlier).alias("carried"))
    )
    own = F.struct("block", "head")
    several = (
        parts.join(carried, BLOCK)
        .withColumn("of", F.when(F.col("head").isNull() & F.col("inside"), F.col("carried")).otherwise(own))
        .groupBy("file", "of")
        .agg(
            F.max("first").alias("first"),
            F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"),
        )
        .select(
            "first",
            F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        )
        .select("first", text.alias("record"))
    )
    return single.where(F.trim("record") != "").unionByName(several)


def _is_header(record: Column, names: list[str]) -> Column:
    # One column more than there are names: a longer header is another one.
    schema = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    found = F.from_csv(record, schema, OPTIONS)
    held = found[f"c{len(names)}"].isNull()
    for i, name in enumerate(names):
        held = held & found[f"c{i}"].eqNullSafe(F.lit(name))
    return held


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = False
) -> DataFrame:
    """As ``read_csv``, for files whose quoted values may hold line ends.

    Each file starts with its header; another header is an error, and a quote that is
    never closed as well. A quote inside a value without quotes is not allowed, since
    quotes are counted. Rows come in no order.
    """
    wrong = F.raise_error(F.concat(F.lit("wrong header: "), "record")).cast("boolean")
    header = F.when(_is_header(F.col("record"), schema.fieldNames()), F.lit(False)).otherwise(wrong)
    body = records(spark, path).where(F.when(F.col("first"), header).otherwise(F.lit(True)))
    mode = {"mode": "FAILFAST"}
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(quarantine.BAD_ROW, T.StringType())])
        mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": quarantine.BAD_ROW}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("record", ddl, OPTIONS | mode)
    return body.select(row.alias("row")).select("row.*")
