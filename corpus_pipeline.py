"""A corpus pipeline over `documents`: quality, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; the last returns a row for each packed piece.

Null texts count as empty, and empty texts pass through every stage as any other. Fully repeated rows become one in exact_dedup; of equal texts
the largest doc_id stays, of near ones the smallest. Null doc_ids are rows of their own. Columns beyond those of documents are
carried along whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import shared_dir, table
from granary.llm.exact_dedup import drop_exact
from granary.llm.omh_dedup import drop_near
from granary.llm.packing import pack_documents
from granary.llm.quality_gam import classified, train
from granary.llm.queries import tokenizer

CAPACITY, THRESHOLD = 2048, 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores at the threshold or above; it learns from the labelled ones among docs."""
    model = train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    return classified(rows, model, threshold=THRESHOLD).where("predicted = 1").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest doc_id."""
    return drop_near(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of CAPACITY tokens."""
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), CAPACITY)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: The classifier, the sketches and the packer have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
