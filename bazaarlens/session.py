"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings, applied only where the caller left the default in place.
# Skewed join keys are split by AQE; the force flag lets it do so even when a
# following aggregation had hoped to reuse the join's partitioning. Table sizes
# are estimated from compressed files; the factor keeps a side that is small
# only on disk from being broadcast. A task reads at most 16 MB of shuffled rows,
# a quarter of the default: a stage that sorts its rows and holds them in
# several hash tables takes up to fifty times that.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    explicit = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "bazaarlens", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        # Do not record the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Checkpoints go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    return configure(builder.getOrCreate())
