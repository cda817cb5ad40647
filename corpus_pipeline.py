"""Corpus pipeline: quality rules, quality classifier, near-dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumencat.llm import stages
from lumencat.llm.common import discard, new_path, stored, table

#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [
    ("quality_rules", stages.quality_rules),
    ("quality_classifier", stages.quality_classifier),
    ("simhash_dedup", stages.simhash_dedup),
    ("packing", stages.packing),
]

#: The classifier and the quantile sketches are not expressible in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents.

    What a stage keeps is a table in the shared folder, so no text is judged
    twice; it is deleted once its successor is written. The last one stays, as
    the result is read from it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = new_path(spark)
        docs = stored(stage(spark, docs, sf_dir), path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
