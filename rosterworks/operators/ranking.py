"""The first rows of every key, without sorting a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to this limit Spark itself cuts every partition to the first rows of a key before the shuffle.
GROUP_LIMIT = 1000
SALTS = 64


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, name: str, spread: Sequence[str]) -> DataFrame:
    """df with the place of each row among those of its key (from 1), cut at ``limit``.

    The limit is a constant, so that a plan with a small one ranks within partitions first. Beyond ``GROUP_LIMIT``, where Spark
    does not, rows are dealt by a hash of the columns ``spread`` and each deal is cut first: the last ranking gets at most
    ``SALTS * limit`` rows of a key. ``order`` should end with a unique column.
    """
    ranked = lambda rows, *by: rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= limit)
    if limit > GROUP_LIMIT:
        df = ranked(df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS))), *keys, "_salt").drop("_salt")
    return ranked(df, *keys)
