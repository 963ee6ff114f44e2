"""A corpus pipeline of five stages; each works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. SQL can express neither decoding, tiling nor the iterated pattern scores, so there is no
ORACLE_SQL; tests hold the
stages against plain versions on small tables, toxicity against its own scorer text by text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterworks.llm.common import materialize
from rosterworks.llm.decontaminate import drop_leaks
from rosterworks.llm.jaccard import keep_first
from rosterworks.llm.mixing import mix
from rosterworks.llm.pii import redact
from rosterworks.llm.queries import MIX_WEIGHTS, table
from rosterworks.llm.toxicity import drop_toxic, train


def small_batches(spark: SparkSession) -> None:
    """Texts are long: a thousand of them are an Arrow batch, so that Python workers and the JVM's buffers for them stay small.

    The setting is the session's, since a stage's result is computed when the caller writes it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.5; null and empty texts hold no word, and rows repeat as they come."""
    small_batches(spark)
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by shingle sets, the one with the smallest doc_id.

    Of rows that repeat it one stays; null, empty and blank texts are linked with nothing; rows without doc_id stay.
    """
    small_batches(spark)
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaked into; null and empty texts hold none, copies go together."""
    small_batches(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; null texts stay null, equal texts stay equal."""
    small_batches(spark)
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The weighted mixture: documents by epoch, the last of a leaf cut to its budget.

    Null sources and languages are groups of their own; documents without words cost nothing.
    """
    return mix(docs, total_share=0.6, weights=MIX_WEIGHTS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
