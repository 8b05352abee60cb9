"""From documents to packed sequences: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acopio.llm.common import Scratch, apart, documents
from acopio.llm.line_dedup import line_dedup
from acopio.llm.mixing import mix
from acopio.llm.near_dedup import drop_near
from acopio.llm.packing import best_fit_packing
from acopio.llm.quality_model import drop_poor

ORACLE_SQL = None
#: The columns that hold a document's place in the mixture between the last two stages.
PLACE = ("mix_slot", "mix_at")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return drop_poor(docs, documents(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    base, back = apart(docs, "doc_id", "text", "n_chars")
    more = tuple(c for c in base.columns if c not in ("doc_id", "text", "n_chars"))
    out = line_dedup(base, min_docs=10, min_chars=1, carry=more).withColumnRenamed("kept_text", "text")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*back)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word shingles and a similarity of 0.8."""
    return drop_near(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, interleaved by their sources' weights, with their places in the mixture."""
    return mix(docs, place=PLACE)


def best_fit_packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of the permitted lengths, which follow the mixture."""
    return best_fit_packing(docs, order=PLACE if set(PLACE) <= set(docs.columns) else None)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
