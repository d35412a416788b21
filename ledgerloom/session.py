"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Aggregates of hundreds of columns compile to methods the JVM never
        # optimises; above this many bytecodes the split-up form is faster.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
