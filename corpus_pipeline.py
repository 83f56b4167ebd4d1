"""The corpus pipeline: five filters and transformations of ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and gets what the stage before it kept; all but the last
return documents with their columns. Between stages the documents are written and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.decontamination import drop_contaminated
from tidings.llm.lines import drop_boilerplate
from tidings.llm.near_duplicates import drop_near_duplicates
from tidings.llm.packing import pack_documents
from tidings.llm.queries import table, tokenizer
from tidings.llm.tables import stored_alone
from tidings.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that more than one in fifty pages of their source repeats.

    ``n_chars`` follows the text where it has changed.
    """
    cleaned = drop_boilerplate(docs, "source")
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", chars).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, 0.8), its smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, and their places in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Learned scores and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and reread.

    What a stage stored on its way, and the documents that it got, are removed when its own are written.
    """

    def kept(done: int) -> DataFrame:
        if not done:
            return table(spark, sf_dir, "documents")
        name, stage = STAGES[done - 1]
        return stored_alone(lambda: stage(spark, kept(done - 1), sf_dir), name)

    return STAGES[-1][1](spark, kept(len(STAGES) - 1), sf_dir)
