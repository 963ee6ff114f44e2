"""Streams of landed contact files and of attempts, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge as M
from ..operators import rollups as R
from ..sources import store

MERGES = (
    ("accounts", R.account_rollup, ("account_id",), M.ACCOUNT_RULES),
    ("contacts", R.contact_rollup, ("contact_id",), M.CONTACT_RULES),
    ("relationships", R.relationship_rollup, ("relationship_id",), M.RELATIONSHIP_RULES),
)


def current(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    """The table as the merged batches have left it; None before the first."""
    try:
        return spark.read.parquet(f"{folder}/{table}").drop(store.PART)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def _merged_before(spark: SparkSession, log: str) -> bool:
    try:
        return spark.read.schema("batch bigint").json(log).first() is not None
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return False


def merge_batch(folder: str, as_of: Column, parts: int = store.PARTS) -> Callable[[DataFrame, int], dict]:
    """A foreachBatch function: merges a batch of raw contacts into the three tables below ``folder``.

    Only the partitions that the batch's keys fall into are read and written. A log line closes each table's merge: a replayed
    batch skips tables that have it, and one that broke off before it is merged again, which changes nothing that was done.
    Returns what became of the rows of each table.
    """

    def run(batch: DataFrame, number: int) -> dict:
        spark, counts = batch.sparkSession, {}
        rows = R.normalized(batch, as_of).persist()
        try:
            for table, rollup, keys, rules in MERGES:
                log = f"{folder}/{table}_log/batch_{number}"
                if _merged_before(spark, log):
                    continue
                source = rollup(rows, as_of)
                counts[table] = store.upsert(folder, table, source, rules, keys, parts, source.schema)
                spark.createDataFrame([(number,)], "batch bigint").coalesce(1).write.mode("overwrite").json(log)
        finally:
            rows.unpersist()
        return counts

    return run


def normalize_landed(spark: SparkSession, landing: str, folder: str, schema, as_of: Column) -> StreamingQuery:
    """Merge all contact files that have landed and stop: the periodic job of the library."""
    stream = spark.readStream.schema(schema).parquet(landing)
    return stream.writeStream.foreachBatch(lambda batch, number: merge_batch(folder, as_of)(batch, number) and None).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def running_status(attempts: DataFrame) -> DataFrame:
    """Fetch state per account over a stream of attempts, for update mode; state is one row per account."""
    return attempts.groupBy("account_key").agg(
        F.max_by("status", F.struct("attempted_at", "attempt_id")).alias("fetch_status"), F.count_if(F.col("status") == "blocked").alias("blocked_attempt_count"), F.max("attempted_at").alias("last_fetch_attempt_at")
    )
