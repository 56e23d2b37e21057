"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Each stage takes and returns the columns of ``documents``; the last one returns the packing. Documents with
null or empty texts are rejected by the first stage. Rows that share an id, or have none, are handled each for
itself by all stages; columns beside those of ``documents`` are carried along, whatever their names; an empty
table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import exact_dedup, jaccard, mixing, packing, quality
from tallybook.llm.common import collapsed, cut, free_name, with_row, word_count


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on them without labels, does not reject."""
    return quality.keep_good(docs, quality.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8), the one with the smallest id."""
    return jaccard.drop_near_duplicates(docs, jaccard.Rule(5, 80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, whole, each as often as it takes it."""
    number = free_name(docs.columns, "row_number")
    rows, _ = with_row(docs, "doc_id", number)
    mixed = mixing.mix(rows, word_count(F.col("text")), whole=True, row_col=number)
    return mixing.take_copies(rows, mixed, number).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document, or piece of one, stands in sequences of 2,048 words."""
    return packing.pack(docs, word_count(F.col("text")), F.xxhash64(collapsed(F.col("text"))))


STAGES = [
    ("quality classifier", reject_poor),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier is trained, and packing searches bins one after the other: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs
