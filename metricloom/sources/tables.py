"""Layers, temporary views, run folders and published tables.

A run writes every table to its own folder and the checks read those folders. The
run is then accepted by one line in the log under the same root, which is one
file moved into place: readers in any process find the newest accepted run there
and see all of its tables or none. Catalog views of the same names are an extra
for SQL. Nothing is copied to publish.
"""

from __future__ import annotations

import datetime
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_FOLDER = "spark.checkpoint.dir"

LAYERS = ("staging", "core", "kpi")
LOG_COLUMNS = "position long, accepted_at string, run_id string"


def new_root(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see; only a local session may do without the setting."""
    shared = spark.conf.get(SHARED_FOLDER, None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{SHARED_FOLDER} must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="metricloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_layers(spark: SparkSession) -> None:
    """One namespace per layer."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Name lazy DataFrames for use from SQL; nothing is computed."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_path(root: str, run_id: str, name: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/{name}"


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/accepted"


def accepted_runs(spark: SparkSession, root: str) -> DataFrame:
    """The log: one line for each time a run was accepted."""
    try:
        return spark.read.schema(LOG_COLUMNS).json(log_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_COLUMNS)


def current_run(spark: SparkSession, root: str) -> str | None:
    """The run accepted last."""
    newest = F.max_by("run_id", F.struct("position", "accepted_at", "run_id"))
    return accepted_runs(spark, root).agg(newest).first()[0]


def was_accepted(spark: SparkSession, root: str, run_id: str) -> bool:
    return bool(accepted_runs(spark, root).where(F.col("run_id") == run_id).take(1))


def accept(spark: SparkSession, root: str, run_id: str) -> None:
    """Make a run the current one, in one step."""
    last = accepted_runs(spark, root).agg(F.coalesce(F.max("position"), F.lit(0))).first()[0]
    now = datetime.datetime.now(datetime.timezone.utc).isoformat()
    line = spark.createDataFrame([(last + 1, now, run_id)], LOG_COLUMNS)
    line.coalesce(1).write.mode("append").json(log_path(root))


def published(
    spark: SparkSession, root: str, name: str, run_id: str | None = None
) -> DataFrame:
    """A table of the current run, or of another accepted one; no other can be read so."""
    if run_id is None:
        run_id = current_run(spark, root)
        if run_id is None:
            raise LookupError(f"no accepted run under {root}")
    elif not was_accepted(spark, root, run_id):
        raise LookupError(f"run {run_id!r} was not accepted")
    return spark.read.parquet(run_path(root, run_id, name))


def write_run_table(
    df: DataFrame, root: str, run_id: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write one table of a run and hand back a reader of the written files.

    Later steps start from the files, so no step is computed twice and a lost
    executor costs one stage. A run that failed may be run again over its own
    files; whether the id may still be used is for the run to check. Rows of a
    partitioned table come laid out by its partition columns.
    """
    path = run_path(root, run_id, name)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def name_table(
    spark: SparkSession, root: str, run_id: str, name: str, tags: Sequence[str] = ()
) -> None:
    """Point ``layer.table`` in the catalog at the run's files."""
    path = run_path(root, run_id, name).replace("`", "``")
    properties = f"TBLPROPERTIES ('run_id' = '{run_id}', 'tags' = '{','.join(tags)}')"
    spark.sql(f"CREATE OR REPLACE VIEW {name} {properties} AS SELECT * FROM parquet.`{path}`")
