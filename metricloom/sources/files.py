"""CSV and Parquet files in and out, and the dated landing area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricloom import fixed_values as fixed
from metricloom.sources import quarantine, quoted_csv, schemas

_CSV = {"header": True, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = False
) -> DataFrame:
    """Headed CSV with a declared schema; a wrong header is an error, and a wrong row too.

    With ``keep_bad`` a row with too few or too many values is kept, its text in a
    further column. A file is split between tasks at its line ends, so a value may not
    hold one; ``quoted_csv`` reads files in which some do.
    """
    mode = {"mode": "FAILFAST"}
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(quarantine.BAD_ROW, T.StringType())])
        mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": quarantine.BAD_ROW}
    return spark.read.schema(schema).options(**_CSV, enforceSchema=False, **mode).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV that ``read_csv`` gives back unchanged."""
    (
        df.write.mode("overwrite")
        .options(
            **_CSV,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
        )
        .csv(path)
    )


def read_raw(
    spark: SparkSession, folder: str, keep_bad: bool = False, quoted_line_ends: bool = False
) -> dict[str, DataFrame]:
    """The three raw sources from ``<folder>/<name>.csv``."""
    read = quoted_csv.read_quoted_csv if quoted_line_ends else read_csv
    return {
        name: read(spark, f"{folder}/{name}.csv", schema, keep_bad)
        for name, schema in schemas.RAW.items()
    }


def customer_ids(raw_customers: DataFrame) -> DataFrame:
    """Only the key column of the customer source."""
    return raw_customers.select("customer_id")


def paying_customers(raw_customers: DataFrame) -> DataFrame:
    """Key and segment of the customers whose segment has a price."""
    return raw_customers.where(F.col("segment").isin(fixed.PAYING_SEGMENTS)).select(
        "customer_id", "segment"
    )


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to types, each with ``<name>_text`` for texts that have no such value."""
    casts = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    kept = {
        f"{name}_text": F.when(cast.isNull(), F.col(name)) for name, cast in casts.items()
    }
    return df.withColumns(casts | kept)


def land(df: DataFrame, path: str, ds: str | Column) -> None:
    """Write one run date's extract; a repeated run replaces only that date.

    ``ds`` is the run date, or a column when several dates land at once. One
    date is written as it comes, without a shuffle; several are laid out by
    date first, evenly even when one date holds most of the rows.
    """
    if isinstance(ds, str):
        dated = df.withColumn("ds", F.lit(ds).cast("date"))
    else:
        dated = df.withColumn("ds", ds.cast("date")).hint("rebalance", F.col("ds"))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .parquet(path)
    )


def read_landed(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Landed extracts, pruned to the run dates ``first`` … ``last``."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("ds") >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col("ds") <= F.lit(last).cast("date"))
    return df
