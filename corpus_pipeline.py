"""From raw documents to packed training sequences: five stages, each written and read again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import decontaminate, line_dedup, quality, simhash
from forecourt.llm.common import read, stored
from forecourt.llm.queries import packed


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a learned rule reject go."""
    return quality.keep_documents(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share go from all but one; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs, min_chars=40, min_docs=5)
    counted = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", counted).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest id stays."""
    return simhash.representatives(docs, shingle=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_items(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Learned rules, fingerprints, edit distances and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is stored and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
