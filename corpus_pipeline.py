"""The corpus pipeline: stages over documents, each written and read again before the next.

Quality rules drop what they reject; of each group of near-duplicates one document stays; documents
with benchmark items are dropped; secrets are replaced by their kind; what is left is packed into
sequences. All stages but the last return the columns of documents, whatever further columns the table has.

Null and empty texts are too short for the quality rules and go with the first stage; by themselves the
other stages keep them, as texts without words, items, secrets, or tokens but the end's. Null languages
and keys are kept as they are; of repeated rows one stays; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracecut.llm import decontaminate, jaccard, packing, quality, secrets
from tracecut.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near enough to some language."""
    return quality.keep_good(docs, COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates; the others go, links across the group included."""
    return jaccard.one_of_each(docs, COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item in them."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars of changed texts counted anew."""
    return secrets.redacted(docs, COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece of each document, with its sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("packing", pack_sequences),
]

#: Packing assigns rows by a linear program over token counts, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each on all that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
