"""Session settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(cores: str = "8", partitions: int = 8, memory: str = "8g", app: str = "skein") -> SparkSession:
    """A local session for tests and the bench; on a cluster, pass your own session to the operators."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
