"""Schemas of the canonical tables, and what brings any table into one of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])


SCHEMAS: dict[str, T.StructType] = {
    "accounts": _schema(
        "account_id string, account_key string, email_domain string, account_name string, inferred_brand string, account_city string, account_state string, website_url string,"
        " account_type string, account_status string, classification string, confidence_score double, classification_confidence double, name_confidence double, brand_confidence double,"
        " location_confidence double, website_confidence double, classification_source_url string, name_source_url string, brand_source_url string, location_source_url string, website_source_url string,"
        " fetch_status string, blocked_reason string, blocked_attempt_count bigint, last_fetch_attempt_at timestamp, last_fetch_success_at timestamp, last_checked_at timestamp, last_verified_at timestamp,"
        " source_type string, source_table string, is_personal_domain boolean, first_seen_at timestamp, last_seen_at timestamp, created_at timestamp, updated_at timestamp"
    ),
    "contacts": _schema(
        "contact_id string, source_contact_id string, full_name string, first_name string, last_name string, email string, email_domain string, is_personal_email boolean, domain_type string,"
        " role_type string, role_family string, role_title string, contact_status string, confidence_score double, source_type string, source_table string, source_url string,"
        " first_seen_at timestamp, last_seen_at timestamp, created_at timestamp, updated_at timestamp"
    ),
    "relationships": _schema(
        "relationship_id string, account_id string, contact_id string, relationship_type string, is_primary boolean, relationship_status string, confidence_score double, source_type string,"
        " source_table string, source_url string, first_seen_at timestamp, last_seen_at timestamp, created_at timestamp, updated_at timestamp"
    ),
    "sync_status": _schema(
        "target_system string, source_record_type string, source_record_id string, target_record_id string, sync_status string, last_synced_at timestamp, last_error string, detail string, created_at timestamp, updated_at timestamp"
    ),
    "work_items": _schema(
        "work_item_id string, task_type string, account_key string, status string, priority bigint, attempt_count bigint, lease_owner string, lease_expires_at timestamp, last_attempt_at timestamp,"
        " next_attempt_at timestamp, completed_at timestamp, last_error string, created_at timestamp, updated_at timestamp"
    ),
    "runs": _schema(
        "run_id string, task_type string, worker_id string, requested_batch_size bigint, claimed_count bigint, succeeded_count bigint, failed_count bigint, run_status string, run_notes string,"
        " started_at timestamp, completed_at timestamp, created_at timestamp, updated_at timestamp"
    ),
    "snapshots": _schema(
        "snapshot_id string, snapshot_at timestamp, accounts bigint, classified bigint, dealers bigint, vendors bigint, contacts bigint, web_contacts bigint, relationships bigint, blocked bigint,"
        " enriched bigint, pending_work bigint, retry_work bigint, completed_work bigint, failed_work bigint, created_at timestamp"
    ),
}
KEYS = {
    "accounts": ("account_id",),
    "contacts": ("contact_id",),
    "relationships": ("relationship_id",),
    "sync_status": ("target_system", "source_record_type", "source_record_id"),
    "work_items": ("task_type", "account_key"),
    "runs": ("run_id",),
    "snapshots": ("snapshot_id",),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: cast where they exist, typed nulls where not. Other columns go."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def read_or_empty(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A canonical table, or an empty one of its schema where nothing has been written yet."""
    try:
        found = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return spark.createDataFrame([], SCHEMAS[table])
    return conform(found, SCHEMAS[table])


def append_rows(df: DataFrame, path: str, table: str) -> None:
    conform(df, SCHEMAS[table]).write.mode("append").parquet(path)


def bad_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once, with their count; empty for a sound table."""
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(nulls | (F.col("n") > 1))
