"""From raw documents to training batches: each stage works on all that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heatmart.llm import cotraining, minhash_dedup, packing, repeats
from heatmart.llm.common import shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"))
    return cotraining.scored(docs, model).where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Rows without id stay; rows that share the kept id all stay.
    """
    groups = minhash_dedup.near_duplicates(docs)
    lost = groups.where("not kept").select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier, n_chars counted anew.

    A character that a removal cuts through is dropped whole. Texts of which
    nothing is left go; texts that were NULL or empty before stay.
    """
    left = repeats.without_repeats(docs, keep_columns=True, as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    rest = left.withColumn("text", text).where((F.col("n_removed") == 0) | (F.col("text") != ""))
    return rest.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document that is left."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packed)]
# Training a classifier and choosing buckets by dynamic programming have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each one's rows written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        done = stage(spark, docs, sf_dir)
        done.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(done.schema).parquet(f"{folder}/{name}")
    return docs
