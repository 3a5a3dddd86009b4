"""The corpus pipeline: toxicity, SimHash near-dedup, suffix-array dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns the next one's documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import packing, pii, simhash, suffix_dedup, toxicity
from strataloom.llm.common import dropped, stored, table

CARRIED = ("lang", "source")
COLUMNS = ("doc_id", "text", "lang", "source")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents; n_chars is that of the text as it is now."""
    return df.select(*COLUMNS, F.length("text").cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return _documents(toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), carried=CARRIED))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of copies and near copies."""
    return _documents(simhash.one_of_each(docs, carried=CARRIED))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that start earlier too; none is dropped, some may be empty."""
    left = suffix_dedup.suffix_dedup(docs, texts=True, carried=CARRIED)
    return _documents(left.select("doc_id", F.col("kept").alias("text"), *[F.col(f"_{c}").alias(c) for c in CARRIED]))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind."""
    found = pii.personal_data(docs, redact=True, carried=CARRIED)
    return _documents(found.select("doc_id", F.col("redacted").alias("text"), *[F.col(f"_{c}").alias(c) for c in CARRIED]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.packed(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("suffix_dedup", cut_repeats), ("personal_data", redact), ("packing", pack)]

#: No stage can be expressed in SQL: tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored in the shared folder before the next reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, at = stored(stage(spark, docs, sf_dir), name)
        if before:
            dropped(spark, before)
        before = at
    return STAGES[-1][1](spark, docs, sf_dir)
