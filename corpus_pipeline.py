"""From raw documents to packed training sequences, in five stages.

Every stage takes the documents that the one before kept and returns documents
with the same columns; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldframe.llm import bagminhash, linetemplates, mixing, packing, quality
from foldframe.llm.queries import acceptable, table, tokenizer_file
from foldframe.session import saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the documents that the quality classifier keeps, repeated rows and rows
    with a null doc_id too, each as often as it is there."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), acceptable(), F.col("source"), F.col("lang"))
    kept = saved(judged.where("keep").select(F.col("row_group").alias("_kept")).distinct(), "kept")
    group = quality.row_group(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("text"))
    return docs.join(kept.hint("shuffle_merge"), group == F.col("_kept"), "left_semi")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: all documents, without the lines of recurring templates."""
    done = linetemplates.drop_recurring(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each near-duplicate class."""
    return bagminhash.one_of_each(docs, similarity=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the mix of sources at weights 1, 2, 3; a document that it takes
    several times is there as often."""
    return mixing.mixed_rows(docs, weights=(1.0, 2.0, 3.0), max_copies=3, preference=mixing.longer_first(F.col("text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file(), size=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# a fitted classifier, BagMinHash and a tokenizer are beyond SQL; tests/llm holds the line
# and near-duplicate stages against brute force, the others against their operators, and these
# against brute force, held-out labels or a round trip
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
