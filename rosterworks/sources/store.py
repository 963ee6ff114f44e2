"""Canonical tables as folders of files, laid out by a hash of the key.

A merge reads and rewrites only the partitions that its batch touches, and tells from that one write what became of
the rows. Files of older schemas are read together with newer ones. Spark's own dynamic partition overwrite does the work: a failed
write leaves the old files, and a batch that is merged again changes nothing.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import Rule, merge_upsert, overwrite
from .schemas import KEYS, SCHEMAS, conform

#: The column that names a partition, and how many there are unless a table is made with another number.
PART, PARTS = "key_part", 64


def scratch(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, shared by all machines; a session on one machine may do without the setting."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterworks-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """df written once and read again, so that what follows does not compute it anew."""
    path = f"{scratch(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def read(spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The table with its partition column; columns that older files lack are null, a table that was never written is empty."""
    wanted = T.StructType([*(SCHEMAS[table] if schema is None else schema).fields, T.StructField(PART, T.IntegerType())])
    try:
        return spark.read.schema(wanted).parquet(f"{folder}/{table}")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], wanted)


def upsert(folder: str, table: str, source: DataFrame, rules: Mapping[str, Rule] | None = None, keys: Sequence[str] | None = None, parts: int = PARTS, schema: T.StructType | None = None) -> dict[str, int]:
    """Merge source into the table; returns how many rows were inserted, updated and kept, and how many partitions written.

    Counts come from the write itself; "kept" are the other rows of the partitions written, untouched partitions are neither
    read nor counted. Without ``rules`` source replaces all columns but the keys. Source is evaluated once; its
    keys must be unique and not null.
    """
    spark = source.sparkSession
    schema, keys = schema or SCHEMAS[table], list(keys or KEYS[table])
    rules = {f.name: overwrite for f in schema if f.name not in keys} if rules is None else rules
    fresh = staged(conform(source, schema).withColumn(PART, part_of(keys, parts)), f"{table}-batch")
    touched = sorted(r[0] for r in fresh.select(PART).distinct().collect())  # at most ``parts`` numbers
    if not touched:
        return {"inserted": 0, "updated": 0, "kept": 0, "partitions": 0}
    old = read(spark, folder, table, schema).where(F.col(PART).isin(touched)).drop(PART)
    merged = merge_upsert(old, fresh.drop(PART), keys, rules, tag="_how").withColumn(PART, part_of(keys, parts))
    seen = Observation()
    counts = [F.count_if(F.col("_how") == how).alias(name) for how, name in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))]
    merged.observe(seen, *counts).drop("_how").hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{table}")
    return {**seen.get, "partitions": len(touched)}


def append(folder: str, table: str, rows: DataFrame) -> int:
    """Add rows to a table that only grows, such as the run log; returns how many, as counted by the write."""
    seen = Observation()
    conform(rows, SCHEMAS[table]).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(f"{folder}/{table}")
    return seen.get["rows"]
