"""Session with the settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are runtime decisions by observed size: joins turn into broadcasts only below the
# size threshold, and skewed shuffle partitions of a join are split. `force...` lets a join be split
# even when the next aggregation would otherwise have reused its partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the call site of every column expression takes a third of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tradeloom", master: str | None = None, **extra: str) -> SparkSession:
    """Start (or reuse) a session; `extra` wins over the defaults above (dots written as `__`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
