"""Session settings for tests, the benchmark and local runs.

On a cluster the session is given; nothing in the package builds one itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Results never depend on the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Run-time plans: joins by measured size, merged and split partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No call-site capture per expression; it doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "metricloom", **extra: str) -> SparkSession:
    """A single-machine session; ``extra`` keys use ``__`` in place of dots."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
