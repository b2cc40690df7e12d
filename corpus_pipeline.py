"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before has kept, and gives the columns of
`documents` less the rows it rejects; the last one gives the packed pieces. A stage's result is written to the shared
folder and read again, so a later failure never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm.common import stored, table
from tripgrain.llm.decontaminate import drop_leaks
from tripgrain.llm.packing import pack_documents
from tripgrain.llm.quality_model import fit_nearest, score_quality
from tripgrain.llm.quality_rules import judge_quality
from tripgrain.llm.queries import tokenizer_file
from tripgrain.llm.simhash import one_of_each


def boxed(docs: DataFrame) -> DataFrame:
    """The documents' columns as one, `row`, beside id and text: whatever they are called, no result replaces them."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good. It learns from the labels of the documents at hand."""
    scored = score_quality(boxed(docs), fit_nearest(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("predicted") == 1).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and all thresholds."""
    return judge_quality(boxed(docs)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with a checksum of their ids."""
    pieces = pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # nearest neighbours, tokenizers and packing are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
