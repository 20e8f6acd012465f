"""Five stages from raw documents to packed training sequences.

Every stage works on all rows its predecessor kept, and all but the last return the columns they got, whatever
further columns there are. A null text counts as empty everywhere; repeated rows are judged alike; an empty table
gives an empty table. The stages share executors, whose Java part grows to its whole share of their memory on the way: so that
their Python workers do with the rest, every stage sets small Arrow batches for the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import lean, table, written
from rosterline.llm.decontam import drop_leaks
from rosterline.llm.nearcopies import keep_dissimilar
from rosterline.llm.packing import pack_documents
from rosterline.llm.pii import mask_documents
from rosterline.llm.quality import fit_documents, graded, keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely to be of the highest grade, by the model fitted on those of ``docs`` that have labels; without any label, all."""
    lean(spark)
    return keep_good(docs, fit_documents(docs, graded(table(spark, sf_dir, "labels"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group whose five-word shingles chains of pairs at 0.8 or more join.

    The Gray index over fingerprints of these shingles links what differs in few bits, the rest is met by bands of minima.
    """
    lean(spark)
    return keep_dissimilar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; without items, all."""
    lean(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data masked and their length brought up to date; a null text stays null."""
    masked = mask_documents(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences; an empty document is its end id alone."""
    lean(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Only the base patterns of the fourth stage can be said in SQL; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``, with a written table between two stages."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = written(docs)
    return docs
