"""Reading the given tables, and tables kept between the steps of one operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see. Only a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="metricloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that a lost executor costs no lineage.

    The write's shuffle files go as soon as it is done; nothing reads them again.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(folder)
    table.stored_in = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that no later step reads. Other tables are left alone."""
    for table in tables:
        if not hasattr(table, "stored_in"):
            continue
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_in)
        conf = table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path.getFileSystem(conf).delete(path, True)
