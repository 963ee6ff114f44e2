"""The Spark session that tests, the bench and the entry file share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "rosterworks", cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session in UTC with adaptive execution; a running session is reused as it is."""
    return (
        SparkSession.builder.master(os.environ.get("SPARK_MASTER", f"local[{cpus}]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
