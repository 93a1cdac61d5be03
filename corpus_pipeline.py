"""A corpus pipeline of five stages; each stage's result is written as Parquet and read as the next one's documents.

Toxic documents go, repeated lines go, one document of each group of near copies stays, documents with passages of the
benchmark go, and the rest is packed into training sequences.  A stage judges all that its predecessor kept.

All stages take whole texts of any length, repeated ids and rows, an empty table, and columns of any other name, which
they pass on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake.llm import decontaminate, line_dedup, packing, simhash, toxicity
from marelake.llm.common import store, table
from marelake.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels of the training fold.

    Null and empty texts score below it; repeated rows all stay or all go.
    """
    model = toxicity.fit(docs, toxicity.train_labels(table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least three hold and another one keeps.

    A null text becomes the empty one; documents without an id keep all lines; ``n_chars`` is counted anew.
    """
    kept = line_dedup.apply(docs, line_dedup.drop_bitmaps(docs))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row, with the operator's shingle length and bit distance.

    Rows are told apart by id and text: the smallest id stays, rows without one come last, of equal rows one stays.
    Null and empty texts are one group.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item; null and empty texts hold none."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is the empty one and has its end mark alone."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_near_copies),
    ("benchmark decontamination", drop_contaminated), ("packing", pack),
]

#: learned decisions, fingerprints and tokens have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
