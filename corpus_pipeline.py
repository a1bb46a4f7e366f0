"""From raw documents to sharded training data: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stereobate.llm import decontam, mixing, neardup, quality, shards
from stereobate.llm._io import save

SHARDS = 24
#: Similarity in percent at which two documents count as near-duplicates.
SIMILAR = 80


def _named(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _own(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts are scored as texts without features, equal texts fare alike, rows without a doc_id are
    scored too. Without labels all documents stay. No column of ``docs`` is read but doc_id and text.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = _named(docs, "quality_score")
    return quality.score(docs, quality.fit(docs, labels), name).where(F.col(name) >= quality.THRESHOLD).select(_own(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows that share a doc_id stay or go together.

    Null and empty texts have no near-duplicates and stay, and so do rows without a doc_id. Of a group the smallest
    doc_id stays.
    """
    gone = neardup.near_duplicates(docs, SIMILAR).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(_own(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null and empty texts and rows without a doc_id stay."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them, in training order, repeats as rows of their own.

    Null and empty texts have no words, so that the mix takes nothing of them. The null source is one of its own.
    """
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes: nearly equal bytes in every shard. Null texts weigh 8 bytes, equal rows stand side by side."""
    return shards.shard_by_bytes(docs, SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier is learned, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
