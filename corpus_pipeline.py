"""A corpus made ready for training: from documents to packed sequences.

Every stage takes all documents that the one before kept and returns the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityframe.llm.decontaminate import find_contamination
from entityframe.llm.jaccard_join import link_components
from entityframe.llm.line_dedup import drop_repeated_lines
from entityframe.llm.packing import pack_documents
from entityframe.llm.quality import good_labels, score_quality
from entityframe.llm.store import stage

NEAR_WORDS = 5
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go: junk and toxic ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, good_labels(labels)).where("keep").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the text, and ``n_chars`` follows it; every document stays."""
    kept = drop_repeated_lines(docs)
    size = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size.cast("bigint")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays, once.

    Documents without words are in no group. Rows of one id go together; of those that stay, each
    different text stays once.
    """
    linked = stage(link_components(docs.select("doc_id", "text"), NEAR_WORDS, NEAR_PERCENT), "linked")
    # Written, so that Spark knows their size when it chooses the joins with the texts.
    gone = stage(linked.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    repeated = stage(
        linked.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id"),
        "repeated",
    )
    left = docs.join(gone, "doc_id", "left_anti")
    once = left.join(repeated, "doc_id", "left_anti")
    again = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(docs.columns).unionByName(again.select(docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark windows go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).where("not contaminated").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", packing),
]

# A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
