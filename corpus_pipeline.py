"""The corpus pipeline: five stages over the documents table, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the
columns of ``documents``; each stage works on all that the one before it kept:

1. quality: documents that the weak-label classifier rejects go;
2. simhash: of each group of near copies (4-word shingles, 4 bits) the one with the least id,
   then text hash, stays;
3. decontaminate: documents in which a benchmark window (10 words) occurs go;
4. pii: personal data becomes its class, disclosing terms are generalised or removed;
5. tokens: each text becomes its byte-level BPE ids, checked by decoding them.

Documents without an id take no part in near-dedup and stay; of repeated rows (same
id and text) one stays.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlens.llm import bpe, decontaminate, pii, quality, simhash  # noqa: E402
from feedlens.llm.common import fresh, stored, table, text_of  # noqa: E402
from feedlens.session import ship_package  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    first = simhash.first_of_groups(docs.select("doc_id", "text").filter("doc_id is not null"))
    tag, row, first_id, first_tag = fresh(docs, "text_tag", "row_of_text", "first_id", "first_tag")
    first = first.toDF(first_id, first_tag)
    # repeated rows first, a row for each task at most is shuffled; then texts and choice meet by the same keys
    repeats = Window.partitionBy("doc_id", tag).orderBy(F.xxhash64(*docs.columns))
    one = docs.filter("doc_id is not null").withColumn(tag, F.xxhash64(text_of()))
    one = one.withColumn(row, F.row_number().over(repeats)).filter(F.col(row) == 1)
    kept = one.join(first, (F.col("doc_id") == F.col(first_id)) & (F.col(tag) == F.col(first_tag)), "left_semi")
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path, pattern = bpe.public_vocabulary()
    narrow = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.encode(narrow, path, pattern)
    intact = F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("_decoded_sha256")
    return coded.select("doc_id", "lang", "source", F.col("_n_tokens").alias("n_tokens"), F.col("_ids").alias("ids"),
                        F.col("_ids_sha256").alias("ids_sha256"), intact.alias("round_trip"))


STAGES = [
    ("quality", keep_quality),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", sanitise),
    ("tokens", tokenise),
]

#: SQL can express neither the fitted classifier, nor XXH64 fingerprints, nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
