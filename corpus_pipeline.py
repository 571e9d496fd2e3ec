"""From raw documents to packed training batches.

The stages keep all columns of ``documents`` up to the last, which returns the packed sequences. Each
works on all rows that its predecessor kept; its result is written and read again, so a lost executor
repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.decontaminate import without_matches
from pricewright.llm.packing import pack
from pricewright.llm.pii import sanitize
from pricewright.llm.simhash import one_of_each
from pricewright.llm.tables import read, small_batches, stage
from pricewright.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    small_batches(spark)
    return without_toxic(docs, fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id."""
    small_batches(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    small_batches(spark)
    return without_matches(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are generalised or removed from the texts."""
    clean = sanitize(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of padded sequences, a row for each sequence."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]
#: The fitted classifier and the dynamic program have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stage(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = store.table(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
