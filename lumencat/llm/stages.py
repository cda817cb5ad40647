"""Stages of the corpus pipeline: each applies one operator to the documents its predecessor kept.

A stage is (spark, docs, sf_dir) -> DataFrame and returns the columns of
documents, the last one the packed pieces. Columns of docs are only carried, so
further columns stay; a null text or id is treated as each operator states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packing as packing_op
from . import quality_classifier as classifier
from . import quality_rules as rules
from . import simhash
from .common import checkpointed, stored, table
from .queries import WORD_BPE


def _wrapped(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and all columns as one, so that no name of theirs clashes."""
    return docs.select("doc_id", "text", "lang", "source", F.struct("*").alias("whole_doc"))


def _unwrapped(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*[F.col("whole_doc")[c].alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fixed base and the adaptive thresholds of their language and source.

    The thresholds are fitted on all documents of this stage. The texts are
    read twice rather than shuffled; the sketches, read at three levels, are kept.
    """
    limits = rules.thresholds(checkpointed(rules.sketch(rules.with_stats(docs.select("text", "lang", "source")))))
    return _unwrapped(rules.judged(rules.with_stats(_wrapped(docs)), limits).where("qr_kept"), docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more.

    It learns from the labelled rows of the whole documents table: what the
    rules kept holds hardly any bad examples.
    """
    usable = classifier.remainder(F.col("doc_id"), 5) != 0
    model = classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable)
    return _unwrapped(classifier.scored(_wrapped(docs), model, name="qc_score").where("qc_score >= 0.3"), docs)


def _row_keys(docs: DataFrame) -> dict[str, Column]:
    """Hashes of a row's text and of the whole row: with the id they tell rows apart unless all their columns agree."""
    rest = [c for c in docs.columns if c != "text"]
    return {"sd_text": F.xxhash64("text"), "sd_row": F.xxhash64(F.lit(1), "text", F.to_json(F.struct(*rest)))}


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the least by id (null ids last), fingerprint and hashes of its text and row.

    Every group keeps a row, also where ids are null or one id has several texts.
    The kept rows' keys are a table of their own: Spark joins the texts with it,
    by a shuffle beyond its broadcast threshold.
    """
    keys = _row_keys(docs)
    found = checkpointed(simhash.rooted(docs, carry=keys))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("sd_id"), "fp", *keys)
    keep = stored(found.groupBy("root").agg(F.min(order).alias("first")).select("first.sd_id", *[F.col(f"first.{k}").alias(f"{k}_kept") for k in keys]))
    repeated = found.count() > found.select("doc_id", *keys).distinct().count()
    match = F.col("doc_id").eqNullSafe(F.col("sd_id"))
    for k in keys:
        match = match & (F.col(k) == F.col(f"{k}_kept"))
    kept = docs.select("doc_id", F.struct("*").alias("whole_doc"), *[c.alias(k) for k, c in keys.items()]).join(keep, match, "left_semi")
    # rows that agree in all columns
    return _unwrapped(kept.dropDuplicates(["doc_id", *keys]) if repeated else kept, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents, packed into sequences."""
    return packing_op.harmonic_pack(docs, WORD_BPE)
