"""A cleaning pipeline over ``documents``: each stage works on what the one before it kept.

All stages but the last return the columns of ``documents``. A document that a stage rejects goes as a whole row;
rows that repeat an id are rejected together; rows without an id pass the filtering stages, as no decision names them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import Scratch, sized_join, table
from tremorlake.llm.minhash import near_duplicates
from tremorlake.llm.packing import pack_tokens
from tremorlake.llm.quality import quality_rules
from tremorlake.llm.secrets import redact
from tremorlake.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Ids of rejected documents are copied to the executors up to this counted number (8 bytes each).
COPIED_IDS = 2_000_000


def _without(docs: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    """``docs`` without the rows of the rejected ids, which are worked out once."""
    ids = Scratch(docs.sparkSession, label).stage(rejected.where("doc_id is not null").select("doc_id").distinct(), "rejected", keep=True)
    return sized_join(docs, ids, ["doc_id"], "left_anti", COPIED_IDS).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted by boilerplate lines go."""
    return _without(docs, quality_rules(docs).where("not kept"), "quality")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the labels of the training fold are learned from, on the texts still there."""
    return _without(docs, toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 1"), "toxicity")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return _without(docs, near_duplicates(docs).where("not kept"), "near-dedup")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked, copied examples under a mask of their own; ``n_chars`` follows."""
    masked = redact(docs.select(*COLUMNS), F.concat_ws("/", "source", "lang"), F.col("source"))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in length buckets and token-budget batches."""
    return pack_tokens(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("secret_scans", secrets_stage),
    ("packing", packing_stage),
]

#: Learned scores, word sets and optimal buckets are beyond SQL; a brute-force version stands in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name, keep=True)
    return docs
