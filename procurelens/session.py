"""Session factory used by the benchmark, the tests and ad-hoc scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str = "local[*]", shuffle_partitions: int = 8,
                  memory: str = "8g", **extra: str) -> SparkSession:
    """Create a session with the settings every operator here assumes.

    Adaptive execution coalesces small shuffle partitions, splits skewed join
    partitions and turns a sort-merge join into a broadcast one when the
    *measured* size of a side is below the threshold. On a cluster pass a large
    ``shuffle_partitions``; AQE merges what turns out to be too small.
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.driver.memory", memory)
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
