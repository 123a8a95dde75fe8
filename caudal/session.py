"""Session settings. On a cluster the caller brings its own session; these are for local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every result in this library relies on; safe to set on any session.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Adaptive execution does the skew splitting and the partition sizing. All but the
# last two are Spark's defaults, written down because the plans in this library count on them.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Split a skewed join even where that costs one more shuffle downstream: a hot client
    # in a single task costs far more than re-shuffling an already joined fact.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lake tables have a directory per month, 372 at most. The driver lists them; a job for it, with a task for
    # each directory, would come before every read of a table.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "400",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "caudal", extra: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**REQUIRED, **ADAPTIVE, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session somebody else created."""
    for key, value in {**REQUIRED, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark
