"""A training corpus in five stages, each one operator: from documents to packed sequences.

Each stage takes what its predecessor kept, written as Parquet and read again.  Further columns of the documents are
handed on, whatever their names; an empty table stays empty, with its columns, to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm import decontaminate, packing, quality, secret_scan, simhash
from stowage.llm.common import document_key, table, tagged, untagged
from stowage.session import apply_settings, keep_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule, or whose host is rejected, go.

    A null or empty text has no words and goes; documents without a host are judged by their own rules alone.
    """
    return quality.kept_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints (three words, two bits) one document stays.

    It is the one with the least id, a null id last; among rows with that id the one whose text, then whose other
    columns have the least hash.  Rows that are equal in all columns stay once.
    """
    rows, own = tagged(docs, _id="doc_id", _text="text")
    rest = [c for c, name in zip(own, docs.columns) if name != "text"]
    rows = rows.select(
        *own,
        F.when(F.col("_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("_id").cast("string"))).alias("_key"),
        F.xxhash64("_text").alias("_hash"),
        F.sha2(F.to_json(F.struct(*rest)), 256).alias("_rest"),
    )
    found = simhash.near_duplicates(docs, words=3, radius=2)
    one = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("c"))
    key = F.when(F.col("c.no_id"), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("c.doc_id").cast("string")))
    chosen = one.select(key.alias("_key"), F.col("c.text_hash").alias("_hash"))
    chosen = rows.join(chosen, ["_key", "_hash"], "left_semi").groupBy("_key", "_hash").agg(F.min("_rest").alias("_rest"))
    kept = rows.join(chosen, ["_key", "_hash", "_rest"], "left_semi").dropDuplicates(["_key", "_hash", "_rest"])
    return untagged(kept, own, docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    A null or empty text holds none and stays; rows with one id and one text go or stay together; an empty benchmark
    takes nothing away.
    """
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = keep_table(found.filter("contaminated").select(F.col("key").alias("_bad")).distinct(), "contaminated")
    rows, own = tagged(docs, _id="doc_id", _text="text")
    clean = rows.join(bad, document_key(F.col("_id"), F.col("_text")) == F.col("_bad"), "left_anti")
    return untagged(clean, own, docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays.

    ``n_chars`` follows the text.  Null and empty texts stay as they are, and so do repeated rows.
    """
    return secret_scan.redacted_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece in packed sequences.

    A null or empty text is one piece that holds the end token alone; repeated rows are packed one by one.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Fingerprints, tokens and the lexer are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Runs jobs: each stage's result is stored in the shared folder."""
    docs = table(apply_settings(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


