"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heatmart.llm import (
    bpe, contamination, cotraining, embedding_dedup, hard_negatives, licenses, main_text,
    masked_lm, minhash_dedup, packing, periodic_runs, repeats, syncmers)
from heatmart.llm.common import table
from heatmart.llm.oracles import SQL  # noqa: F401

# Folder of the public vocabulary files, described in its README.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return masked_lm.scored(spark, docs, *masked_lm.train(docs))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"))
    return cotraining.scored(docs, model).select("doc_id", "p_text", "p_meta", "score", "keep")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.expr("transform(embedding, x -> floor(256 * double(x)))").alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item"]), lambda i: i.isNotNull())))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where a tenth of the texts goes on as a loop from some word on, both chosen by the id's checksum.

    Those texts get single blanks; NULL ids and texts without words stay.
    """
    texts = docs.select("doc_id", F.col("text").alias("own"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    looped = texts.where("h % 10 = 0 and rlike(own, '[^ \\t-\\r]')").selectExpr(
        "doc_id", "h div 10 as g", "regexp_extract_all(own, '[^ \\t-\\r]+', 0) as w").selectExpr(
        "doc_id", "g", "w", "int(g % size(w)) as a").selectExpr(
        "doc_id", "w", "a", "int(1 + (size(w) - a) div (3 + g % 8)) as p").selectExpr(
        "doc_id", "array_join(transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p])), ' ') as text")
    rest = texts.where("not coalesce(h % 10 = 0 and rlike(own, '[^ \\t-\\r]'), false)").select("doc_id", F.col("own").alias("text"))
    return looped.union(rest)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")))
    # length / period compared without division: words of a text fit 31 bits
    best = F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period then int(signum(y.length * x.period - x.length * y.period))
        when x.start <> y.start then int(signum(x.start - y.start)) else int(signum(x.period - y.period)) end)""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("best", F.get(best, F.lit(0)))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_dedup, op2_minhash_dedup, op3_syncmer_fingerprints, op4_suffix_dedup, op5_masked_lm, op6_license_scan,
        op7_main_text, op8_quality, op9_packing, op10_bpe, op11_hard_negatives,
        op12_decontamination, op13_periodic_runs)}
