"""Readers of the input tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``root``; the path can be in any store that Spark reads."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


#: So many rows are one task's work where each becomes a page that is parsed.
ROWS_A_TASK = 4_000


def spread(df: DataFrame, key: str, rows: int = ROWS_A_TASK) -> DataFrame:
    """df dealt by a hash of ``key`` over one partition for every ``rows`` rows, counted first.

    A narrow table is few splits however much work its rows make later on; the number is given, so that adaptive
    execution does not put the small partitions together again.
    """
    return df.repartition(max(1, math.ceil(df.count() / rows)), key)
