"""Corpus pipeline: quality filter, near-dedup, PII, source mixing, sequence packing.

Every stage reads the written result of the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagelake.llm import mixing, packing, pii, quality, simhash
from usagelake.llm.common import staged, table

# share of the remaining tokens that the mixture takes; no document is repeated
MIX_FRACTION = 0.9
MIX_EPOCHS = 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash.deduplicated(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` is that of the new text."""
    out = pii.redacted(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture of sources."""
    return mixing.mixed(docs, fraction=MIX_FRACTION, max_epochs=MIX_EPOCHS).select("doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packing.op8(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", simhash_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# SQL cannot express the stages; the tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{n}")
    return docs
