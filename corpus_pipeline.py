"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

1. quality rules: documents whose posterior quality is low go (weak supervision);
2. n-gram Jaccard join: of each group of near-duplicates (five words, 0.8) one document stays;
3. benchmark decontamination: documents that hold benchmark passages go;
4. secret scans: secrets in what is left are replaced, and n_chars follows;
5. SentencePiece sampling: three distinct segmentations of each document, as digests.

Rows are dropped only by a stage's decision: null or empty texts fail the quality rules, rows
without a doc_id can't be named as copies or leaks and stay, extra columns pass through all stages
but the last, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stoptide.llm.common import forget, read_table, stored
from stoptide.llm.decontaminate import drop_leaks
from stoptide.llm.ngram_join import keep_one_each
from stoptide.llm.quality import quality_filter
from stoptide.llm.sampling import segmentation_digest
from stoptide.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules keep."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest doc_id, of each group of near-duplicates."""
    return keep_one_each(docs, 5, 4, 5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark passages."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    return redact_secrets(docs, length="n_chars" if "n_chars" in docs.columns else None)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples segmentations of the texts."""
    return segmentation_digest(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("SentencePiece sampling", segmentations),
]

#: Expectation-maximisation, connected components and sampling have no SQL; the tests are by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; a stage's table goes once the next one is written."""
    docs, held = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
        if held is not None:
            forget(held)
        held = docs
    return STAGES[-1][1](spark, docs, sf_dir)
